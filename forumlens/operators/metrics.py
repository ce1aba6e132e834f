"""Classifier evaluation (A8-A12, P9) as distributed aggregates.

Inputs are rows ``(label, prediction[, score])`` with 0/1 labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.operators.ranking import running_sums
from forumlens.session import materialize


def confusion_matrix(df: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Fixed 2 x 2 matrix; rows = actual class, columns = predicted."""
    counts = df.groupBy(F.col(label).cast("double").alias("label")).agg(
        F.count_if(F.col(prediction) == 0).alias("pred_0"),
        F.count_if(F.col(prediction) == 1).alias("pred_1"))
    classes = df.sparkSession.range(2).select(
        F.col("id").cast("double").alias("label"))
    return (classes.join(counts, "label", "left")
            .select("label", F.coalesce("pred_0", F.lit(0)).alias("pred_0"),
                    F.coalesce("pred_1", F.lit(0)).alias("pred_1")))


def _safe_div(a, b):
    return F.when(b != 0, a / b)


def binary_metrics(df: DataFrame, label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """Accuracy and per-class precision, recall, F1 in one pass.

    ``precision``/``recall`` without a class are what the reference prints:
    both equal to accuracy.  Undefined ratios are null.
    """
    y, p = F.col(label), F.col(prediction)
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
               F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 1) & (p == 0)).alias("fn"),
               F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    acc = _safe_div(tp + tn, n)
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    return c.select(
        "tp", "fp", "fn", "tn", acc.alias("accuracy"),
        acc.alias("precision"), acc.alias("recall"),
        p1.alias("precision_1"), r1.alias("recall_1"),
        _safe_div(2 * p1 * r1, p1 + r1).alias("f1_1"),
        p0.alias("precision_0"), r0.alias("recall_0"),
        _safe_div(2 * p0 * r0, p0 + r0).alias("f1_0"))


def misclassified(df: DataFrame, label: str = "label",
                  prediction: str = "prediction") -> DataFrame:
    """Rows whose prediction differs from the label."""
    return df.where(F.col(prediction) != F.col(label))


def score_counts(df: DataFrame, label: str = "label",
                 score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score (partial + final agg)."""
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"))


def curve_areas(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """A11 + A12: ``(auc_roc, auc_pr)`` as one row, exact, from one scan of
    the input.

    Positives and negatives are counted per distinct score and written; the
    running sums over the descending scores come from ``running_sums``, and
    both areas are sums over that table.  ROC: trapezoids between
    consecutive distinct scores (ties get half credit, as Mann-Whitney with
    mid-ranks).  PR: the curve starts at (recall 0, first precision).  Where
    a class is absent the areas are null.
    """
    counts = materialize(score_counts(df, label, score), "score-counts")
    c = running_sums(counts, [F.desc("score")], {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")})
    pos, neg, tp, fp = (F.col(x).cast("double") for x in ("pos", "neg", "cum_pos", "cum_neg"))
    before_tp, before_all = tp - pos, tp - pos + fp - neg
    precision = tp / (tp + fp)
    before = F.when(before_all == 0, precision).otherwise(before_tp / F.when(before_all != 0, before_all))
    t = c.agg(F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"),
              F.sum(neg * (2 * tp - pos)).alias("roc"), F.sum(pos * (precision + before)).alias("pr"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return t.select(F.when(both, F.col("roc") / F.when(both, 2 * F.col("P") * F.col("N"))).alias("auc_roc"),
                    F.when(both, F.col("pr") / F.when(both, 2 * F.col("P"))).alias("auc_pr"))


def auc_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """A11 alone, see ``curve_areas``."""
    return curve_areas(df, label, score).select("auc_roc")


def auc_pr(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """A12 alone, see ``curve_areas``."""
    return curve_areas(df, label, score).select("auc_pr")
