"""Metrics against Spark's evaluators; hash sampling is layout-independent."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from forumlens.operators import metrics as M
from forumlens.operators import sampling as R


def _scored(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = float(rng.random() < 0.4)
        s = round(rng.random() * 0.7 + 0.3 * y, 2)  # rounded: many ties
        rows.append((i, y, s, float(s >= 0.5)))
    return spark.createDataFrame(rows, "Id long, label double, score double, prediction double")


def test_auc_matches_evaluator(spark):
    df = _scored(spark)
    for metric, fn in (("areaUnderROC", M.auc_roc), ("areaUnderPR", M.auc_pr)):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                           metricName=metric, numBins=0).evaluate(df)
        assert abs(fn(df).first()[0] - ev) < 1e-12


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_curve_areas_in_ranges_of_any_size(spark, monkeypatch, rows):
    from forumlens.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", rows)
    df = _scored(spark).limit(60) if rows == 1 else _scored(spark)
    got = M.curve_areas(df).first()
    for metric, value in (("areaUnderROC", got["auc_roc"]), ("areaUnderPR", got["auc_pr"])):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0).evaluate(df)
        assert abs(value - ev) < 1e-12


def test_places_and_running_sums(spark, monkeypatch):
    from forumlens.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 9)
    names = [None, ""] + [f"n{i:03d}" for i in range(100)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, x int").repartition(5)
    got = {r["name"]: r["place"] for r in ranking.with_place(df, "name").collect()}
    assert got == {n: i + 1 for i, n in enumerate(names)}
    sums = ranking.running_sums(df, [F.desc("x")], {"s": F.col("x"), "n": F.lit(1)})
    assert {r["x"]: (r["s"], r["n"]) for r in sums.collect()} == {x: (sum(range(x, 102)), 102 - x) for x in range(102)}
    assert ranking.with_place(df.limit(0), "name").collect() == []


def test_auc_of_hard_predictions_is_balanced_accuracy(spark):
    df = _scored(spark)
    c = M.binary_metrics(df).first()
    bal = (c["recall_1"] + c["recall_0"]) / 2
    auc = M.auc_roc(df, score="prediction").first()[0]
    assert abs(auc - bal) < 1e-12


def test_confusion_matrix_fixed_shape_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0)], "label double, prediction double")
    cm = sorted(map(tuple, M.confusion_matrix(df).collect()))
    assert cm == [(0.0, 0, 0), (1.0, 1, 1)]
    m = M.binary_metrics(df).first()
    assert m["accuracy"] == 0.5 and m["precision"] == 0.5 and m["recall"] == 0.5
    assert m["precision_0"] == 0.0 and m["recall_0"] is None and m["recall_1"] == 0.5


def test_misclassified(spark):
    df = _scored(spark)
    n = M.misclassified(df).count()
    assert n == df.where(F.col("label") != F.col("prediction")).count() > 0


def test_hash_split_is_partition_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "Id")
    a = R.hash_split(df.repartition(1), "Id")
    b = R.hash_split(df.repartition(7), "Id")
    for x, y in zip(a, b):
        assert sorted(r[0] for r in x.collect()) == sorted(r[0] for r in y.collect())
    assert a[0].count() + a[1].count() == 2000
    assert 1250 < a[0].count() < 1550


def test_stratified_sample_fractions(spark):
    df = spark.range(4000).select(F.col("id").alias("Id"),
                                  (F.col("id") % 4 == 0).cast("double").alias("label"))
    s = R.stratified_sample(df, "label", {0.0: 0.9, 1.0: 0.5}, id_col="Id")
    got = {r["label"]: r["count"] for r in s.groupBy("label").count().collect()}
    assert 2550 < got[0.0] < 2850 and 400 < got[1.0] < 600
    s2 = R.stratified_sample(df.repartition(5), "label", {0.0: 0.9, 1.0: 0.5}, id_col="Id")
    assert sorted(s.collect()) == sorted(s2.collect())


def test_auc_undefined_with_one_class(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.7)], "label double, score double")
    assert M.auc_roc(df).first()[0] is None
    assert M.auc_pr(df).first()[0] is None
