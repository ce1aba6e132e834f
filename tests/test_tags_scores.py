"""Tag handling, scores and rankings, with the reference's literals."""

from pyspark.sql import functions as F

from forumlens.functions.tags import clean_tags, tag_array, tag_list
from forumlens.functions.text import java_trim
from forumlens.operators import scores as S
from forumlens.operators import tags as TG
from forumlens.schemas import POSTS


def test_tag_literal_three_items(spark):
    df = spark.createDataFrame([("<education><open-source><education>",)], ["t"])
    r = df.select(clean_tags("t").alias("c"), tag_list("t").alias("l"),
                  tag_array("t").alias("a")).first()
    assert r["c"] == "education open-source education"
    assert r["l"] == ["education", "open-source", "education"]
    assert r["a"] == r["l"]


def test_empty_tag_string(spark):
    r = spark.createDataFrame([("",)], ["t"]).select(
        tag_list("t").alias("l"), tag_array("t").alias("a")).first()
    assert r["l"] == [""] and r["a"] == []


def test_java_trim(spark):
    r = spark.createDataFrame([("\t\x01 a b \n\r",)], ["s"]).select(java_trim("s").alias("t")).first()
    assert r["t"] == "a b"


def test_substring_vs_exact_label(spark):
    df = spark.createDataFrame([(1, "<rust><go>"), (2, "<r>"), (3, "")], ["Id", "Tags"])
    sub = {r["Id"]: r["label"] for r in TG.label_column(df, "r", match="substring").collect()}
    ex = {r["Id"]: r["label"] for r in TG.label_column(df, "r", match="exact").collect()}
    assert sub == {1: 1.0, 2: 1.0, 3: 0.0}
    assert ex == {1: 0.0, 2: 1.0, 3: 0.0}


def test_post_tag_labels(spark):
    posts = spark.createDataFrame([(1, "<rust><go>"), (2, "<r>"), (3, "<c++><c>"), (4, None)],
                                  ["Id", "Tags"])
    vocab = spark.createDataFrame([("r",), ("go",), ("c",), ("c++",), ("ust",)], ["TagName"])
    a = sorted(map(tuple, TG.post_tag_labels(posts, vocab, match="substring").collect()))
    assert a == [(1, "go"), (1, "r"), (1, "ust"), (2, "r"), (3, "c"), (3, "c++")]
    twice = TG.post_tag_labels(posts.union(posts), vocab, match="substring")
    assert sorted(map(tuple, twice.collect())) == sorted(a + a)      # repeated posts keep their rows
    exact = sorted(map(tuple, TG.post_tag_labels(posts, vocab).collect()))
    assert exact == [(1, "go"), (2, "r"), (3, "c"), (3, "c++")]


def _posts(spark, rows):
    return spark.createDataFrame(rows, POSTS)


def test_user_tag_score_duplicates_and_empty_keys(spark):
    rows = [
        (1, 1, None, "<a><b><a>", None, None, None, 10),
        (None, 2, 1, None, None, None, 2.0, 7),
        (None, 2, 1, None, None, None, 3.0, 7),
        (None, 2, 1, None, None, None, 1.0, 8),
        (None, 2, None, None, None, None, 9.0, 9),   # no parent: never joins
    ]
    got = {(r["UserId"], r["TagId"]): r["TotalScore"]
           for r in S.user_tag_score(_posts(spark, rows)).collect()}
    # duplicate tag 'a' counts twice, as the reference's explode does
    assert got == {(7, "a"): 10.0, (7, "b"): 5.0, (8, "a"): 2.0, (8, "b"): 1.0}


def test_avg_by_key_combiner_literal(spark):
    df = spark.createDataFrame([("Fred", 88.0), ("Fred", 95.0), ("Fred", 91.0),
                                ("Wilma", 93.0), ("Wilma", 95.0), ("Wilma", 98.0)],
                               ["name", "score"])
    got = {r["name"]: r["mean"] for r in S.avg_by_key(df, "name", "score").collect()}
    assert abs(got["Fred"] - 91.33333333333333) < 1e-12
    assert abs(got["Wilma"] - 95.33333333333333) < 1e-12
    m = S.as_key_map(S.avg_by_key(df, "name", "score"), "name", "n").first()["map"]
    assert m == {"Fred": 3, "Wilma": 3}


def test_key_map_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(S, "KEYS_PER_MAP", 50)
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    df = df.union(spark.createDataFrame([(None, 5)], "k string, v long"))
    maps = S.as_key_map(df, "k", "v")
    assert maps.count() > 10 and maps.agg(F.sum(F.size("map"))).first()[0] == 1000
    asked = spark.createDataFrame([("k7",), ("k999",), ("no",), (None,), ("k7",)], "k string")
    assert sorted((r["k"] or "", r["value"]) for r in S.look_up(asked, maps, "k").collect()) == [
        ("", None), ("k7", 7), ("k7", 7), ("k999", 999), ("no", None)]
    empty = S.look_up(asked, S.as_key_map(df.limit(0), "k", "v"), "k")
    assert {r["value"] for r in empty.collect()} == {None}


def test_top_experts_ties_and_numeric_order(spark):
    df = spark.createDataFrame([(1, "t", 9.0), (2, "t", 10.0), (3, "t", 10.0), (4, "u", 1.0)],
                               "UserId long, TagId string, TotalScore double")
    top = S.top_experts(df, 2).orderBy("TagId", "rank").collect()
    assert [(r["TagId"], r["UserId"], r["rank"]) for r in top] == [
        ("t", 2, 1), ("t", 3, 2), ("u", 4, 1)]
    ex = S.experts_for_tag(df, "t").orderBy(F.desc("score")).collect()
    assert ex[0]["score"] == 10.0  # numeric, not '9' > '10'


def test_top_experts_plans_partial_group_limit(spark):
    df = (spark.range(1000).select((F.col("id") % 97).alias("UserId"),
                                   (F.col("id") % 3).cast("string").alias("TagId"),
                                   F.col("id").alias("s"))
          .groupBy("UserId", "TagId").agg(F.sum("s").cast("double").alias("TotalScore")))
    plan = S.top_experts(df, 3)._jdf.queryExecution().executedPlan().toString()
    # a per-partition top-k runs before the shuffle on the tag, so a hot tag
    # sends at most k rows per map partition
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_substring_large_vocab_matches_brute_force(spark):
    import random
    rng = random.Random(5)
    alphabet = "abcde-+"
    names = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6)))
                    for _ in range(300)})
    rows = [(i, "".join(f"<{rng.choice(names)}>" for _ in range(rng.randint(0, 4))))
            for i in range(400)]
    vocab_names = names[::2] + ["a><b", "<a", "x"]
    posts = spark.createDataFrame(rows, ["Id", "Tags"])
    vocab = spark.createDataFrame([(v,) for v in vocab_names], ["TagName"])
    got = sorted(map(tuple, TG.post_tag_labels(posts, vocab, match="substring").collect()))
    want = sorted((i, v) for i, t in rows for v in set(vocab_names) if v in t)
    assert got == want
