"""Sampling and evaluation queries on a deterministic scored-label table.

The scores come from a fixed formula over ``labels`` (the quality label plus
an md5 draw of the doc id), so every metric is reproducible in SQL without
training a model; the trained-model queries live in ``plans.models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.functions.hashing import md5_int
from forumlens.operators import metrics as M
from forumlens.operators import sampling as R
from forumlens.plans import sql
from forumlens.plans.registry import query
from forumlens.sources import fixtures as fx


def scored_labels(spark, sf):
    lab = fx.read_table(spark, sf, "labels")
    score = (F.col("quality") * 3500 + md5_int(F.col("doc_id")) % 6500) / F.lit(10000.0)
    return lab.select(F.col("doc_id").alias("Id"),
                      F.col("quality").cast("double").alias("label"),
                      score.alias("score"),
                      F.when(score >= 0.5, 1.0).otherwise(0.0).alias("prediction"))


_SCORED = f"""scored AS (
  SELECT doc_id AS Id, CAST(quality AS DOUBLE) AS label,
         (quality * 3500 + {sql.md5_int('doc_id')} % 6500) / 10000.0 AS score
  FROM labels),
sp AS (SELECT *, CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
       FROM scored)"""


@query("split_70_30", f"""SELECT doc_id AS Id,
  CASE WHEN {sql.md5_unit('doc_id')} < 0.7 THEN 'train' ELSE 'test' END AS split
FROM documents""")
def split_70_30(spark, sf):
    d = fx.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"))
    return R.split_label(d, "Id", 0.7)


@query("stratified_sample", f"""SELECT doc_id AS Id, CAST(quality AS DOUBLE) AS label FROM labels
WHERE {sql.md5_unit("CAST(doc_id AS VARCHAR) || 's'")} < 0.9""")
def stratified_sample(spark, sf):
    lab = fx.read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("Id"), F.col("quality").cast("double").alias("label"))
    pos = lab.where(F.col("label") > 0.0)
    neg = lab.where(F.col("label") < 1.0)
    both = pos.unionByName(neg)
    return R.stratified_sample(both, "label", {0.0: 0.9, 1.0: 0.9}, id_col="Id",
                               salt="s")


@query("confusion_matrix", f"""WITH {_SCORED}
SELECT c.label, coalesce(pred_0, 0) AS pred_0, coalesce(pred_1, 0) AS pred_1
FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) c(label) LEFT JOIN (
  SELECT label, count_if(prediction = 0) AS pred_0, count_if(prediction = 1) AS pred_1
  FROM sp GROUP BY label) m ON c.label = m.label""")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(scored_labels(spark, sf))


@query("binary_metrics", f"""WITH {_SCORED},
c AS (SELECT count_if(label = 1 AND prediction = 1) AS tp,
             count_if(label = 0 AND prediction = 1) AS fp,
             count_if(label = 1 AND prediction = 0) AS fn,
             count_if(label = 0 AND prediction = 0) AS tn FROM sp),
d AS (SELECT *, tp::DOUBLE AS a, fp::DOUBLE AS b, fn::DOUBLE AS c_, tn::DOUBLE AS d_ FROM c),
r AS (SELECT *, (a + d_) / (a + b + c_ + d_) AS accuracy,
      CASE WHEN a + b <> 0 THEN a / (a + b) END AS p1,
      CASE WHEN a + c_ <> 0 THEN a / (a + c_) END AS r1,
      CASE WHEN d_ + c_ <> 0 THEN d_ / (d_ + c_) END AS p0,
      CASE WHEN d_ + b <> 0 THEN d_ / (d_ + b) END AS r0 FROM d)
SELECT tp, fp, fn, tn, round(accuracy, 10) AS accuracy, round(accuracy, 10) AS precision,
       round(accuracy, 10) AS recall,
       round(p1, 10) AS precision_1, round(r1, 10) AS recall_1,
       round(CASE WHEN p1 + r1 <> 0 THEN 2 * p1 * r1 / (p1 + r1) END, 10) AS f1_1,
       round(p0, 10) AS precision_0, round(r0, 10) AS recall_0,
       round(CASE WHEN p0 + r0 <> 0 THEN 2 * p0 * r0 / (p0 + r0) END, 10) AS f1_0
FROM r""")
def binary_metrics(spark, sf):
    m = M.binary_metrics(scored_labels(spark, sf))
    return m.select("tp", "fp", "fn", "tn", *[F.round(c, 10).alias(c) for c in m.columns[4:]])


@query("misclassified", f"""WITH {_SCORED}
SELECT Id, label, prediction FROM sp WHERE prediction <> label""")
def misclassified(spark, sf):
    return M.misclassified(scored_labels(spark, sf)).select("Id", "label", "prediction")


_CUM = f"""WITH {_SCORED},
g AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
      FROM scored GROUP BY score),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
c AS (SELECT score, pos, neg,
        sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
        sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn
      FROM g)"""


@query("auc_roc", f"""{_CUM}
SELECT round(sum((cn / N - (cn - neg) / N) * (cp / P + (cp - pos) / P) / 2), 10) AS auc_roc
FROM c, t""")
def auc_roc(spark, sf):
    return M.auc_roc(scored_labels(spark, sf)).select(F.round("auc_roc", 10).alias("auc_roc"))


@query("auc_pr", f"""{_CUM}
SELECT round(sum((cp / P - (cp - pos) / P) *
  (cp / (cp + cn) + CASE WHEN (cp - pos) + (cn - neg) = 0 THEN cp / (cp + cn)
                         ELSE (cp - pos) / ((cp - pos) + (cn - neg)) END) / 2), 10) AS auc_pr
FROM c, t""")
def auc_pr(spark, sf):
    return M.auc_pr(scored_labels(spark, sf)).select(F.round("auc_pr", 10).alias("auc_pr"))


@query("holdout_tag_counts", f"""SELECT CASE WHEN {sql.md5_unit('Id')} < 0.7 THEN 'train' ELSE 'test' END
         AS split, count(*) AS n
FROM (SELECT doc_id AS Id, 1 AS PostTypeId, '<' || lang || '><' || source || '>' AS Tags,
             text AS Text FROM documents)
WHERE contains('[' || CAST(Id AS VARCHAR) || ',' || CAST(PostTypeId AS VARCHAR) || ','
               || coalesce(Tags, 'null') || ',' || coalesce(Text, 'null') || ']', 'src1')
GROUP BY ALL""")
def holdout_tag_counts(spark, sf):
    """P8 + A4 per split: rows of the 70/30 hash split whose rendered row
    mentions the target tag, counted in one grouped pass."""
    from forumlens.operators.posts import any_column_contains
    d = fx.document_posts(spark, sf)
    hits = any_column_contains(d, "src1")
    return (R.split_label(hits, "Id", 0.7).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n")))
