"""User-tag expertise scores and rankings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.tags import tag_array, tag_list


def user_tag_score(posts: DataFrame, exact: bool = False,
                   sort: bool = False) -> DataFrame:
    """A1: total answer score per (user, tag) -> ``(UserId, TagId, TotalScore)``.

    Answers join their question (J1) and each of the question's tags gets
    the answer's score, summed per (user, tag).  The tag string is cleaned
    and split on the question side, once per question rather than once per
    answer, before the shuffle.  The aggregate is planned partial + final, so
    a user or tag holding a large share of the rows is pre-summed inside
    each map task; a hot question is split by AQE's skew join.
    """
    tag_fn = tag_array if exact else tag_list
    parents = posts.select(F.col("Id").alias("_parent_id"),
                           tag_fn("Tags").alias("_tags"))
    child = posts.where(F.col("ParentId").isNotNull()).select(
        "ParentId", F.col("OwnerUserId").alias("UserId"), "Score")
    ex = (child.join(parents, F.col("ParentId") == F.col("_parent_id"))
          .select("UserId", "Score", F.explode("_tags").alias("TagId")))
    out = ex.groupBy("UserId", "TagId").agg(
        F.sum(F.col("Score").cast("double")).alias("TotalScore"))
    return out.orderBy("UserId", "TagId") if sort else out


def top_user_tags(scores: DataFrame, n: int = 10) -> DataFrame:
    """O3: the n highest (user, tag) scores; ties by user then tag.

    orderBy + limit plans as TakeOrderedAndProject: a per-partition top-n
    then one merge of n x partitions rows.
    """
    return scores.orderBy(F.desc("TotalScore"), "UserId", "TagId").limit(n)


def top_experts(scores: DataFrame, k: int = 3, tag: str = "TagId",
                user: str = "UserId", score: str = "TotalScore",
                rank: str = "rank") -> DataFrame:
    """The k best users per tag (ties by user id).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle on the tag, so even a tag holding a third of all rows sends at
    most k rows per map partition to its reducer.
    """
    w = Window.partitionBy(tag).orderBy(F.desc(score), F.asc(user))
    return (scores.withColumn(rank, F.row_number().over(w))
            .where(F.col(rank) <= k))


def experts_for_tag(scores: DataFrame, tag_value: str, tag: str = "TagId",
                    user: str = "UserId", score: str = "TotalScore") -> DataFrame:
    """Users with a positive score for one tag, best first.

    The reference's query groups by the score itself and compares strings;
    this is its intent: numeric max per (tag, user), kept when positive.
    """
    return (scores.where(F.col(tag) == tag_value)
            .groupBy(tag, user).agg(F.max(F.col(score).cast("double")).alias("score"))
            .where(F.col("score") > 0))


def avg_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """A2: mean per key through count and sum (Catalyst runs the partial +
    final combine the reference hand-writes) -> ``(key, n, total, mean)``."""
    return df.groupBy(key).agg(
        F.count(F.col(value)).alias("n"),
        F.sum(F.col(value).cast("double")).alias("total"),
        F.avg(F.col(value).cast("double")).alias("mean"))


# keys of one map row, about
KEYS_PER_MAP = 10_000


def as_key_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """A keyed result of any size as rows ``(bucket, buckets, map)``, each
    a map of the keys that hash to it; ``buckets`` is their number.

    A null key has no entry.  Keys must differ, or the map can't be built.
    """
    buckets = max(1, math.ceil(df.count() / KEYS_PER_MAP))
    rows = df.where(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), F.struct(F.col(key), F.col(value)).alias("e"))
    return rows.groupBy("bucket").agg(F.map_from_entries(F.collect_list("e")).alias("map")).select(
        "bucket", F.lit(buckets).alias("buckets"), "map")


def look_up(df: DataFrame, maps: DataFrame, key: str, out: str = "value") -> DataFrame:
    """``df`` with the value of each row's ``key`` in ``as_key_map``'s rows,
    null where there is none.  ``key`` needs the type of the maps' keys."""
    n = maps.agg(F.max("buckets")).first()[0]
    if n is None:
        return df.withColumn(out, F.lit(None))
    bucket = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    rows = df.withColumn("_b", bucket).join(maps.select(F.col("bucket").alias("_b"), F.col("map").alias("_m")), "_b", "left")
    return rows.withColumn(out, F.col("_m")[F.col(key)]).drop("_b", "_m")
