"""Shared plumbing of the llm operators: session settings, staged tables,
row structs and connected components."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import ensure_checkpoint_dir, materialize, shared_path, ship_package

__all__ = ["arrow_session", "connected_components", "held_out", "materialize",
           "row_struct", "shared_path", "read_table", "struct_field"]

# an Arrow batch sent to a Python worker holds at most so many bytes (or one
# row): very long texts then never gather in one batch
ARROW_BATCH_BYTES = "8m"

def arrow_session(df: DataFrame) -> SparkSession:
    """The session, with the package on its workers, Arrow batches bounded in
    bytes and the shared checkpoint folder known."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    ensure_checkpoint_dir(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: Column | str, modulus: int, remainder: int) -> Column:
    """crc32(key as text) mod ``modulus`` = ``remainder``; a null key is
    never held out."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))


def row_struct(df: DataFrame, *more: Column) -> DataFrame:
    """The whole row as one column ``row`` (so no column of the input can
    clash with what an operator adds), besides ``more``."""
    return df.select(F.struct("*").alias("row"), *more)


def struct_field(batch: pa.RecordBatch, name: str, column: str = "row") -> pa.Array:
    return pc.struct_field(batch.column(batch.schema.get_field_index(column)), name)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): for each node of the undirected ``links`` the smallest
    node that it reaches.

    Alternating large-star and small-star steps.  Every step is two grouped
    minimums, which Spark pre-aggregates, so a node with very many links does
    not gather in one task; each step is written to the shared folder, which
    cuts the lineage.  Self links and nulls are ignored.
    """
    spark = links.sparkSession
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u <> v").distinct())
    e = materialize(e, "cc")
    state = None
    while True:
        # large star: every larger neighbour of u is tied to u's smallest one
        both = e.union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy(F.col("u").alias("k")).agg(
            F.least(F.min("v"), F.col("u")).alias("m"))
        e = (both.where("v > u").join(low, F.col("u") == F.col("k"))
             .select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u <> v").distinct())
        # small star: u and its smaller neighbours are tied to the smallest one
        low = e.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        tied = e.join(low, F.col("u") == F.col("k"))
        e = (tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(low.select(F.col("k"), F.col("m")))
             .where("u <> v").distinct())
        e = materialize(e, "cc")
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")),
                    F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)
