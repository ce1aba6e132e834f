"""Adapters from the driver's parquet tables to the Q&A data model.

questions  <- orders    (Id = o_orderkey, owner = o_custkey,
                         Tags = <priority-slug><status>)
answers    <- lineitem  (ParentId = l_orderkey, owner = l_suppkey,
                         Score = l_quantity; a bag, no key)
text posts <- documents (Tags = <lang><source>, Text = text)
web posts  <- pages     (Title = url, Body = html)
baskets    <- distinct part names per order
edges      <- events    (user, event type as a tag, sum of value)
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.operators.ranking import with_place
from forumlens.session import file_sizes, materialize

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]

# Tables whose rows feed CPU-heavy per-row text work.  Each driver file is a
# single Parquet row group, so its scan yields one non-empty task.
TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


# Input bytes of a partition that rows are spread to.
SPREAD_BYTES = 64 << 20


def spread_if_few_files(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the session's parallelism, or over more
    partitions where one would get more than ``SPREAD_BYTES``, when the scan
    has fewer input files than task slots or files of several times that size
    (a few large single-row-group files give one busy task each).  A table
    laid out in many files, of which 16 times the task slots are enough
    whatever their size, is returned unchanged: no extra shuffle at scale.
    Column pruning still applies below the exchange."""
    spark = df.sparkSession
    par, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if len(files) >= 16 * par:
        return df
    size = sum(file_sizes(spark, files))
    if len(files) < par or size > 4 * SPREAD_BYTES * len(files):
        return df.repartition(max(par, math.ceil(size / SPREAD_BYTES)))
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str,
               spread: bool | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread if spread is not None else name in TEXT_TABLES:
        df = spread_if_few_files(df)
    return df


def order_tags(priority="o_orderpriority", status="o_orderstatus"):
    slug = F.regexp_replace(F.lower(F.col(priority)), " ", "-")
    return F.concat(F.lit("<"), slug, F.lit("><"), F.lower(F.col(status)),
                    F.lit(">"))


def question_posts(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("Id"),
        F.lit(1).alias("PostTypeId"),
        F.lit(None).cast("bigint").alias("ParentId"),
        order_tags().alias("Tags"),
        F.lit(None).cast("string").alias("Title"),
        F.lit(None).cast("string").alias("Body"),
        F.lit(None).cast("double").alias("Score"),
        F.col("o_custkey").alias("OwnerUserId"))


def answer_posts(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.lit(None).cast("bigint").alias("Id"),
        F.lit(2).alias("PostTypeId"),
        F.col("l_orderkey").alias("ParentId"),
        F.lit(None).cast("string").alias("Tags"),
        F.lit(None).cast("string").alias("Title"),
        F.lit(None).cast("string").alias("Body"),
        F.col("l_quantity").cast("double").alias("Score"),
        F.col("l_suppkey").alias("OwnerUserId"))


def qa_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers in one POSTS-typed table (bag union)."""
    return question_posts(read_table(spark, sf_dir, "orders")).unionByName(
        answer_posts(read_table(spark, sf_dir, "lineitem")))


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("Id"),
        F.lit(1).alias("PostTypeId"),
        F.concat(F.lit("<"), F.col("lang"), F.lit("><"), F.col("source"),
                 F.lit(">")).alias("Tags"),
        F.col("text").alias("Text"))


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages")
    return p.select(F.col("page_id").alias("Id"), F.col("url").alias("Title"),
                    F.col("html").alias("Body"))


def order_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(basket_id, items): distinct part names per order, sorted."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .groupBy(F.col("l_orderkey").alias("basket_id"))
            .agg(F.sort_array(F.collect_set("p_name")).alias("items")))


def event_user_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(UserId, TagId, Score): events as user-tag triples, score = sum(value)."""
    e = read_table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").alias("UserId"),
                      F.col("event_type").alias("TagId"))
            .agg(F.sum("value").alias("Score")))


def with_ids(names: DataFrame) -> DataFrame:
    """A vocabulary ``(TagName, ...)`` with ``Id``: each name's place in name
    order, counted range by range."""
    cols = [c for c in names.columns if c != "TagName"]
    return with_place(materialize(names, "names"), "TagName", out="Id").select("Id", "TagName", *cols)


def event_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags vocabulary (Id, TagName, Count) from distinct event types."""
    e = read_table(spark, sf_dir, "events")
    return with_ids(e.groupBy(F.col("event_type").alias("TagName")).agg(F.count(F.lit(1)).alias("Count")))
