"""Hand-written XML / JSON / CSV / text inputs (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from forumlens.operators import text as X
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt
from forumlens.sources import sinks

POSTS_XML = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" Tags="&lt;r&gt;&lt;svm&gt;" Title="T &amp; U" Body="&lt;p&gt;a b&lt;/p&gt;&#xA;x" Score="5" OwnerUserId="7" />
  <row Id="2" PostTypeId="2" ParentId="1" Score="3" Body="ans" />
</posts>
"""


@pytest.mark.parametrize("bom", [False, True])
def test_read_posts_xml(spark, tmp_path, bom):
    p = tmp_path / "posts.xml"
    p.write_text(("﻿" if bom else "") + POSTS_XML, encoding="utf-8")
    rows = {r["Id"]: r for r in fmt.read_posts_xml(spark, str(p)).collect()}
    assert set(rows) == {"1", "2"}
    q, a = rows["1"], rows["2"]
    assert q["Tags"] == "<r><svm>"
    assert q["Title"] == "T & U"
    assert q["Body"] == "<p>a b</p>\nx"
    assert q["ParentId"] == ""          # absent attribute reads as ""
    assert a["Tags"] == "" and a["OwnerUserId"] == ""
    typed = {r["Id"]: r for r in fmt.typed_posts(fmt.read_posts_xml(spark, str(p))).collect()}
    assert typed[2]["ParentId"] == 1 and typed[1]["ParentId"] is None
    assert typed[1]["Score"] == 5.0 and typed[2]["OwnerUserId"] is None


def test_malformed_xml_failfast_and_permissive(spark, tmp_path):
    p = tmp_path / "bad.xml"
    p.write_text('<posts>\n<row Id="1" PostTypeId="1"></posts>\n', encoding="utf-8")
    with pytest.raises(Exception):
        fmt.read_posts_xml(spark, str(p)).collect()
    df = fmt.read_posts_xml(spark, str(p), mode="PERMISSIVE")
    df.collect()  # no exception


def test_read_tags_xml(spark, tmp_path):
    p = tmp_path / "tags.xml"
    p.write_text('﻿<?xml version="1.0" encoding="utf-8"?>\n<tags>\n'
                 '  <row Id="1" TagName="r" Count="10" />\n'
                 '  <row Id="2" TagName="svm" />\n</tags>\n', encoding="utf-8")
    rows = sorted(fmt.typed_tags(fmt.read_tags_xml(spark, str(p))).collect())
    assert [tuple(r) for r in rows] == [(1, "r", 10), (2, "svm", None)]


def test_from_xml_column(spark):
    df = spark.createDataFrame([('<row Id="9" Tags="&lt;a&gt;" />',)], ["value"])
    r = fmt.parse_posts_xml_lines(df).first()
    assert r["Id"] == "9" and r["Tags"] == "<a>" and r["Body"] == ""


def test_xml_row_line_roundtrip(spark):
    df = spark.createDataFrame([(1, 'a & <b> "c"\nd', None)], "Id long, Title string, Body string")
    line = df.select(fmt.xml_row_line(["Id", "Title", "Body"]).alias("value"))
    r = fmt.parse_posts_xml_lines(line).first()
    assert r["Title"] == 'a & <b> "c"\nd' and r["Body"] == ""


def test_read_posts_json(spark, tmp_path):
    p = tmp_path / "posts.json"
    p.write_text('{"row":{"Id":"1","PostTypeId":"1","Tags":"<a>"}}\n'
                 '{"row":{"Id":"2","PostTypeId":"2","ParentId":"1"}}\n')
    rows = fmt.read_posts_json(spark, str(p))
    qs = fmt.json_questions(rows).collect()
    assert [(r["Id"], r["Tags"]) for r in qs] == [("1", "<a>")]
    j = fmt.json_qa_join(fmt.json_questions(rows), fmt.json_answers(rows)).collect()
    assert [(r["ParentId"], r["Tags"]) for r in j] == [("1", "<a>")]


def test_user_tag_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(7, "r", 8.0), (9, "svm", 1.5)], "UserId long, TagId string, TotalScore double")
    out = str(tmp_path / "ut")
    sinks.write_user_tag_csv(df, out, single_file=True)
    back = fmt.typed_user_tag(fmt.read_user_tag_csv(spark, out))
    assert sorted(map(tuple, back.collect())) == [(7, "r", 8.0), (9, "svm", 1.5)]
    text = "".join(open(f).read() for f in __import__("glob").glob(out + "/*.csv"))
    assert "[" not in text  # real CSV, not Row.toString


def test_user_tag_csv_keeps_every_string(spark, tmp_path):
    tags = ["", " a ", 'q"uo"te', "c,omma", "back\\slash", None, "\\", "é"]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(tags)],
                               "UserId long, TagId string, TotalScore double")
    sinks.write_user_tag_csv(df, str(tmp_path / "ut"))
    back = fmt.typed_user_tag(fmt.read_user_tag_csv(spark, str(tmp_path / "ut")))
    assert {r["UserId"]: r["TagId"] for r in back.collect()} == dict(enumerate(tags))


def test_word_list(spark, tmp_path):
    p = tmp_path / "en.txt"
    p.write_text("a\nthe \n\n\tof\n")
    assert sorted(r["word"] for r in fmt.read_word_list(spark, str(p)).collect()) == ["a", "of", "the"]


def test_stop_words_of_any_number(spark, tmp_path):
    """More words than the driver list of earlier versions could take."""
    p = tmp_path / "many.txt"
    p.write_text("\n".join(f"w{i}" for i in range(120_000)) + "\nThe\n")
    rows = [(1, ["the", "W7", "keep", "THE", "keep", "w119999"]), (2, []), (3, None), (4, ["w5"])]
    df = spark.createDataFrame(rows, "Id long, tokens array<string>")
    got = {r["Id"]: r["words"] for r in X.remove_stop_words_table(df, fmt.read_word_list(spark, str(p))).collect()}
    assert got == {1: ["keep", "keep"], 2: [], 3: None, 4: []}


def test_xml_keeps_every_character(spark, tmp_path):
    texts = ["  lead and trail ", "a\nb\tc\rd", "<p>x &amp; \"y\"</p>", "\u00e9\U0001f600", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "Id long, Body string")
    sinks.write_posts_xml(df, str(tmp_path / "x"))
    back = {int(r["Id"]): r["Body"] for r in fmt.read_posts_xml(spark, str(tmp_path / "x")).collect()}
    lines = fmt.parse_posts_xml_lines(df.select(fmt.xml_row_line(["Id", "Body"]).alias("value")))
    assert back == dict(enumerate(texts)) == {int(r["Id"]): r["Body"] for r in lines.collect()}


def test_store_readers_see_whole_versions(spark, tmp_path):
    store = sinks.ModelStore(str(tmp_path / "v"))

    def tables(x):
        w = spark.createDataFrame([("a", 1, x), ("b", 2, x)], "tag string, bucket int, w double")
        return w, w.select("tag", F.col("w").alias("b")), w.select("tag")

    first = store.write_weights(*tables(1.0))
    w, b = store.weights(spark)                               # a reader, pinned to the first version
    other = sinks.ModelStore(str(tmp_path / "v"))             # a retrain, under way
    tables(2.0)[0].write.parquet(other._path(other.run, "weights"))
    assert store.latest(spark) == first
    assert {r["w"] for r in store.weights(spark)[0].collect()} == {1.0}
    second = store.write_weights(*tables(3.0))
    assert store.latest(spark) == second != first
    assert {r["w"] for r in w.collect()} == {1.0} == {r["b"] for r in b.collect()}
    assert {r["w"] for r in store.weights(spark)[0].collect()} == {3.0}
    assert {r["w"] for r in store.weights(spark, first)[0].collect()} == {1.0}


def test_baskets_and_multilabel(spark, tmp_path):
    b = tmp_path / "ff.txt"
    b.write_text(" a b c \nb c\n")
    got = [r["items"] for r in fmt.read_baskets(spark, str(b)).collect()]
    assert sorted(got) == [["a", "b", "c"], ["b", "c"]]
    m = tmp_path / "nb.txt"
    m.write_text("1,0#1 2 3\n2#0 0 4\n")
    rows = sorted((tuple(r["labels"]), tuple(r["features"]))
                  for r in fmt.read_multilabel_vectors(spark, str(m)).collect())
    assert rows == [((1.0, 0.0), (1.0, 2.0, 3.0)), ((2.0,), (0.0, 0.0, 4.0))]


def test_wrapper_line_filter(spark):
    df = spark.createDataFrame([('<?xml version="1.0"?>',), ("<posts>",), ("<row/>",),
                                ("</posts>",)], ["v"])
    assert [r["v"] for r in fmt.filter_wrapper_lines(df, "v").collect()] == ["<row/>"]


def test_model_store_roundtrip(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense([1.0]), 1.0)],
                               ["features", "label"])
    m = LogisticRegression(maxIter=5).fit(df)
    store = sinks.ModelStore(str(tmp_path / "store"))
    path = store.save("c++/odd tag", m)
    assert "c%2B%2B%2Fodd%20tag" in path
    store.write_manifest(spark, [{"tag": "c++/odd tag", "path": path}])
    loaded = store.load(spark, LogisticRegressionModel)
    assert list(loaded) == ["c++/odd tag"]
    assert loaded["c++/odd tag"].coefficients == m.coefficients


def test_model_store_weights_distributed(spark, tmp_path):
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.sparse(6, [0, 1], [1.0, 2.0]), 1.0), (Vectors.sparse(6, [3], [1.0]), 0.0),
            (Vectors.sparse(6, [0], [3.0]), 1.0), (Vectors.sparse(6, [3, 4], [1.0, 1.0]), 0.0)]
    df = spark.createDataFrame(rows, ["features", "label"])
    for cls, kw in ((LogisticRegression, {"maxIter": 10}), (LinearSVC, {"maxIter": 10})):
        store = sinks.ModelStore(str(tmp_path / cls.__name__))
        models = {"a/b c%": cls(**kw).fit(df), "plain": cls(regParam=0.5, **kw).fit(df)}
        for t, m in models.items():
            store.save(t, m)
        store.save("stale", models["plain"])        # of an earlier vocabulary
        store.write_manifest(spark, [{"tag": t, "path": "models"} for t in models])
        w, b = store.weights(spark)
        got = {(r["tag"], r["bucket"]): r["w"] for r in w.collect()}
        want = {(t, int(i)): float(m.coefficients[int(i)]) for t, m in models.items()
                for i in range(6) if m.coefficients[int(i)] != 0}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
        bias = {r["tag"]: r["b"] for r in b.collect()}
        assert all(abs(bias[t] - m.intercept) < 1e-12 for t, m in models.items())


def test_rows_are_spread_by_bytes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a table, 100%")
    spark.range(50000).coalesce(1).write.parquet(path)
    par, size = spark.sparkContext.defaultParallelism, sum(f.stat().st_size for f in (tmp_path / "a table, 100%").glob("*.parquet"))
    df = spark.read.parquet(path)
    assert fx.spread_if_few_files(df).rdd.getNumPartitions() == par
    monkeypatch.setattr(fx, "SPREAD_BYTES", size // 20)
    assert fx.spread_if_few_files(df).rdd.getNumPartitions() >= 20
    many = str(tmp_path / "many")
    spark.range(50000).repartition(2 * par).write.parquet(many)
    assert fx.spread_if_few_files(spark.read.parquet(many)).inputFiles() == spark.read.parquet(many).inputFiles()
    monkeypatch.setattr(fx, "SPREAD_BYTES", 1 << 30)
    df = spark.read.parquet(many)
    assert fx.spread_if_few_files(df) is df


def test_stop_word_table_shuffles_no_row_per_token(spark):
    docs = [(1, ["the", "cat", "the", None, "Mat"]), (2, ["the"]), (3, None), (4, []), (None, ["cat"]), (5, ["b", "the"]), (5, ["a", "mat", "c"])]
    df = spark.createDataFrame(docs, "Id long, tokens array<string>")
    words = spark.createDataFrame([("THE",), ("mat",), (None,), ("the",)], "word string")
    out = X.remove_stop_words_table(df, words)
    got = sorted(((r["Id"], r["words"]) for r in out.collect()), key=str)
    assert got == sorted([(1, ["cat"]), (2, []), (3, None), (4, []), (None, []), (5, ["a", "b", "c"]), (5, ["a", "b", "c"])], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "array_distinct" in plan and "LeftAnti" not in plan
