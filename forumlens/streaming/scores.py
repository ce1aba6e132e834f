"""Running user-tag scores over a stream of answers.

answers stream  --stream-static join-->  questions (static table)
  -> explode tags -> groupBy(UserId, TagId).sum(Score)   (state store)
  -> update mode -> foreachBatch: append changed rows + batch id to a
     changelog table in the shared checkpoint folder.

The current score of a key is its row from the latest batch; ``current``
compacts the changelog with a grouped ``max_by`` (no driver collect, no
single-partition window).  The stream's checkpoint makes a restarted query
resume exactly where it stopped, and a batch that is re-run after a failure
rewrites the same ``batch_id`` partition.

Scale note: a stream-static join reads the static side for every
micro-batch.  With a very large question table, keep it in a layout that
makes that cheap (partitioned/bucketed by question id, or a table of only
the questions still receiving answers), or use longer triggers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions.tags import tag_list


def running_scores(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Streaming A1: ``answers`` is a streaming DataFrame of posts with
    ``ParentId, OwnerUserId, Score``; ``questions`` a static ``(Id, Tags)``."""
    q = questions.select(F.col("Id").alias("_parent_id"),
                         F.col("Tags").alias("_parent_tags"))
    qa = (answers.where(F.col("ParentId").isNotNull())
          .join(q, F.col("ParentId") == F.col("_parent_id"))
          .select(F.col("OwnerUserId").alias("UserId"), "Score",
                  F.explode(tag_list("_parent_tags")).alias("TagId")))
    return qa.groupBy("UserId", "TagId").agg(
        F.sum(F.col("Score").cast("double")).alias("TotalScore"))


def start_changelog(scores: DataFrame, changelog_path: str, checkpoint_path: str,
                    available_now: bool = True, processing_time: str | None = None):
    """Start the update-mode query appending changed rows to ``changelog_path``
    (Parquet, partitioned by ``batch_id``)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(changelog_path))

    w = (scores.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_path))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def current(spark, changelog_path: str) -> DataFrame:
    """Latest score per (user, tag) from the changelog."""
    log = spark.read.parquet(changelog_path)
    return log.groupBy("UserId", "TagId").agg(
        F.max_by("TotalScore", "batch_id").alias("TotalScore"))
