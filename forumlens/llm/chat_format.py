"""Operator 4, chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string.  It is
rendered on every prefix of a conversation; what one more turn appends to the
previous output is that turn's span.  A template whose output for a longer
prefix does not start with the output for the shorter one rewrites history:
such conversations are flagged and get no spans.  Rendering each last turn
once more with a marker as its text gives the lengths of the turn's head and
tail, so where the text itself lies is known without reading the template.

``conversations`` renders every whole prefix of every conversation, whatever
the template says of itself, which takes time that grows with the square of a
conversation's turns and holds three outputs at once.  ``render`` alone can do
with less.  A template that is an ``Appending`` says that each turn's output
is its own and follows the output so far; ``render`` takes its word and
renders each turn once.  Told not to look at ``every`` prefix, it cuts
prefixes to their last ``WINDOW`` turns and compares with prefixes of 1, 2, 4,
8, ... turns only, which may miss a template that rewrites history in between.

The loss mask is the text part of the assistant turns.

``ESCAPED`` is the template of query op4: every turn is between control
strings, and control strings inside roles and texts get an escape after their
first character, which ``unescape`` takes out again.

Defined results: null texts and roles are empty; turns are ordered by number
(null first), then role and text; rows with a null conv_id are one
conversation; repeated rows are turns of their own; other columns are
ignored.  The rows of a conversation are sorted by Spark (spilling to disk)
and streamed; a task holds one conversation's text, which is one value of the
result anyway.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import arrow_session

# fixed values: control strings of the template and of common chat formats
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
ESCAPE = "\\"
WINDOW = 4                    # turns before the rendered one
MARKER = "\ue000marker\ue001"
ASSISTANT = "assistant"

_ESCAPE = re.compile(r"\\|<(?=\||s>|/s>)|\[(?=/?INST\])")
_UNESCAPE = re.compile(r"\\([\\;])")


def escape(text: str) -> str:
    r"""Double every backslash; put ``\;`` after the first character of each
    control string."""
    if not (ESCAPE in text or "<" in text or "[" in text):
        return text
    return _ESCAPE.sub(lambda m: r"\\" if m[0] == ESCAPE else m[0] + r"\;", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: ESCAPE if m[1] == ESCAPE else "", text)


class Appending:
    """A template that only appends: ``begin``, then ``turn(role, text)`` for
    every turn.  Called like any other template."""

    def __init__(self, begin: str, turn: Callable[[str, str], str]):
        self.begin, self.turn = begin, turn

    def __call__(self, turns: list[tuple[str, str]]) -> str:
        return self.begin + "".join(self.turn(role, text) for role, text in turns)


def escaped_template(turns: list[tuple[str, str]]) -> str:
    return "<s>" + "".join(f"<|{escape(role)}\n<|{escape(text)}</s>\n" for role, text in turns)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of an output of ``escaped_template``."""
    out, at = [], len("<s>")
    while at < len(formatted):
        mid = formatted.index("\n<|", at)
        end = formatted.index("</s>\n", mid)
        out.append((unescape(formatted[at + 2:mid]), unescape(formatted[mid + 3:end])))
        at = end + len("</s>\n")
    return out


def _appended(head: list, turn: tuple[str, str], template: Callable, before: str) -> tuple[str, int, int] | None:
    """(what ``turn`` appends to ``before``, the output for ``head``; start and
    stop of its text in that), or None if more than that changes."""
    now, probe = template(head + [turn]), template(head + [(turn[0], MARKER)])
    at = probe.find(MARKER, len(before))
    if not (now.startswith(before) and probe.startswith(before)) or at < 0:
        return None
    tail = len(probe) - at - len(MARKER)
    if now[:at] != probe[:at] or (tail and now[-tail:] != probe[-tail:]):
        return None
    return now[len(before):], at - len(before), len(now) - tail - len(before)


def _windowed(turns: list, template: Callable) -> tuple[str, list] | None:
    """Output and spans from the last ``WINDOW`` turns of every prefix, if they
    hold for the outputs of whole prefixes."""
    parts, spans, at, checks = [template([])], [], 0, {}
    at = len(parts[0])
    for k, turn in enumerate(turns):
        head = turns[max(0, k - WINDOW):k]
        got = _appended(head, turn, template, template(head))
        if got is None:
            return None
        piece, start, stop = got
        spans.append((at, at + start, at + stop, at + len(piece)))
        parts.append(piece)
        at += len(piece)
        if k + 1 == len(turns) or not (k + 1) & k:      # a power of two
            checks[k + 1] = at
    out = "".join(parts)
    if any(template(turns[:k]) != out[:end] for k, end in checks.items()):
        return None
    return out, spans


def _appending(turns: list, template: Appending) -> tuple[str, list] | None:
    """Output and spans of every prefix, one turn after the other."""
    parts, spans, at = [template.begin], [], len(template.begin)
    for turn in turns:
        got = _appended([], turn, template, template.begin)
        if got is None:
            return None
        piece, start, stop = got
        spans.append((at, at + start, at + stop, at + len(piece)))
        parts.append(piece)
        at += len(piece)
    return "".join(parts), spans


def render(turns: list[tuple[str, str]], template: Callable, every: bool = False) -> tuple[str, list | None]:
    """(output, spans): spans has (start, text start, text stop, stop) per
    turn, or is None if the template rewrites history.  With ``every`` all
    prefixes count, without it a plain function is tried on some."""
    quick = None
    if isinstance(template, Appending):
        quick = _appending(turns, template)
    elif not every:
        quick = _windowed(turns, template)
    if quick is not None:
        return quick
    before, spans = template([]), []
    for k, turn in enumerate(turns):
        got = _appended(turns[:k], turn, template, before)
        if got is None:
            return template(turns), None
        piece, start, stop = got
        at = len(before)
        spans.append((at, at + start, at + stop, at + len(piece)))
        before += piece
    return before, spans


def conversations(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text", template: Callable = escaped_template) -> DataFrame:
    """(conv_id, n_turns, formatted, spans, loss, rewrites_history) per
    conversation; ``loss`` are the [start, stop) ranges of assistant texts.
    Every whole prefix of every conversation is rendered."""
    spark = arrow_session(rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = (turns.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
             .select("conv_id", "role", "text"))

    def one(conv, held):
        out, spans = render(held, lambda prefix: template(prefix), every=True)      # nothing but a function
        cut = [dict(zip(("start", "text_start", "text_stop", "stop"), s)) for s in spans or []]
        loss = [{"start": s[1], "stop": s[2]} for s, (r, _) in zip(spans or [], held) if r == ASSISTANT]
        return conv, len(held), out, cut, loss, spans is None

    span = pa.struct([(k, pa.int64()) for k in ("start", "text_start", "text_stop", "stop")])
    mask = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    types = (pa.int64(), pa.int64(), pa.string(), pa.list_(span), pa.list_(mask), pa.bool_())
    names = ("conv_id", "n_turns", "formatted", "spans", "loss", "rewrites_history")

    def batch(done):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=list(names))

    def run(batches):
        conv, held, done, size = None, [], [], 0
        for b in batches:
            for c, r, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                if held and c != conv:
                    done.append(one(conv, held))
                    size += len(done[-1][2])
                    held = []
                    if size > 1 << 21:
                        yield batch(done)
                        done, size = [], 0
                conv = c
                held.append((r, t))
        if held:
            done.append(one(conv, held))
        if done:
            yield batch(done)

    return turns.mapInArrow(
        run, "conv_id long, n_turns long, formatted string, "
             "spans array<struct<start:long,text_start:long,text_stop:long,stop:long>>, "
             "loss array<struct<start:long,stop:long>>, rewrites_history boolean")


def digest(formatted: DataFrame) -> DataFrame:
    """The result columns of query op4, read back from outputs of
    ``escaped_template`` and their loss masks."""
    def run(batches):
        for b in batches:
            rows = []
            for conv, out, loss in zip(*(b.column(i).to_pylist() for i in range(3))):
                turns = read_back(out)
                said = "".join(unescape(out[s["start"]:s["stop"]]) for s in loss)
                h = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((conv, len(turns), h, len(said), hashlib.sha256(said.encode()).hexdigest(), len(out)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.int64(),
                                                             pa.string(), pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def _escape_sql(col: str) -> str:
    out = f"replace({col}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\;{c[1:]}')"
    return out


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                                  (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) v)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(3 + sum(10 + length({_escape_sql('role')}) + length({_escape_sql('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
