"""The operator renders every whole prefix, whatever a template says of itself."""

import functools

import pytest

from forumlens.llm import chat_format as CH


def test_conversations_take_no_template_at_its_word(spark):
    def turn(role, text):
        return f"{role}: {text}\n"

    class Sly(CH.Appending):      # says that it only appends, but drops its start from the third turn on
        def __call__(self, turns):
            return super().__call__(turns) if len(turns) < 3 else "".join(turn(*t) for t in turns)

    df = spark.createDataFrame([(c, i, "assistant", f"t{i}") for c, n in ((1, 5), (2, 2)) for i in range(n)],
                               "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r for r in CH.conversations(df, template=Sly("<s>", turn)).collect()}
    assert got[1]["rewrites_history"] and not got[1]["spans"] and not got[2]["rewrites_history"]
    assert got[1]["formatted"] == "".join(f"assistant: t{i}\n" for i in range(5))
    whole = {r["conv_id"]: r for r in CH.conversations(df, template=CH.Appending("<s>", turn)).collect()}
    assert not whole[1]["rewrites_history"] and len(whole[1]["spans"]) == 5


def test_the_query_renders_every_prefix_of_its_template():
    seen = []

    @functools.wraps(CH.escaped_template)
    def counted(turns):
        seen.append(len(turns))
        return CH.escaped_template(turns)

    assert not isinstance(CH.escaped_template, CH.Appending)
    talk = [("user" if i % 2 else "assistant", f"text {i} <s>") for i in range(30)]
    text, spans = CH.render(talk, counted, every=True)
    assert seen == [0] + [k for k in range(1, 31) for _ in range(2)]
    assert [CH.unescape(text[a:b]) for _, a, b, _ in spans] == [t for _, t in talk]


@pytest.mark.parametrize("text", ["", "plain", "a [ b < c", r"\;", "<s>[INST]</s><|", "[/INST] \\"])
def test_escape_leaves_no_control_string_and_comes_back(text):
    assert not any(c in CH.escape(text) for c in CH.CONTROL) and CH.unescape(CH.escape(text)) == text
