"""Streaming user-tag scores: incremental batches and restart from the
checkpoint give the batch result."""

from forumlens.operators.scores import user_tag_score
from forumlens.schemas import POSTS
from forumlens.streaming import scores as ST


def test_running_scores_resume(spark, tmp_path):
    qs = [(1, 1, None, "<a><b>", None, None, None, 10), (2, 1, None, "<b>", None, None, None, 11)]
    a1 = [(None, 2, 1, None, None, None, 2.0, 7), (None, 2, 2, None, None, None, 1.0, 7)]
    a2 = [(None, 2, 1, None, None, None, 5.0, 8), (None, 2, 2, None, None, None, 4.0, 7)]
    questions = spark.createDataFrame(qs, POSTS)
    src = tmp_path / "answers"
    base = str(tmp_path / "out")

    def run():
        stream = spark.readStream.schema(POSTS).parquet(str(src))
        q = ST.start_changelog(ST.running_scores(stream, questions),
                               base + "/log", base + "/ckpt")
        q.awaitTermination()
        return {(r["UserId"], r["TagId"]): r["TotalScore"]
                for r in ST.current(spark, base + "/log").collect()}

    spark.createDataFrame(a1, POSTS).write.mode("append").parquet(str(src))
    assert run() == {(7, "a"): 2.0, (7, "b"): 3.0}
    spark.createDataFrame(a2, POSTS).write.mode("append").parquet(str(src))
    got = run()  # restarted query resumes from its checkpoint
    batch = {(r["UserId"], r["TagId"]): r["TotalScore"] for r in user_tag_score(
        questions.unionByName(spark.createDataFrame(a1 + a2, POSTS))).collect()}
    assert got == batch == {(7, "a"): 2.0, (7, "b"): 7.0, (8, "a"): 5.0, (8, "b"): 5.0}
