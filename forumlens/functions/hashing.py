"""Portable hashing: md5 hex prefix -> integer, identical in any SQL engine
that has ``md5`` (Spark, DuckDB).  Used for hashed term buckets and for
deterministic, partition-layout-independent sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_int(value) -> Column:
    """First 32 bits of md5(value as string), as a non-negative bigint."""
    return F.conv(F.substring(F.md5(_c(value).cast("string")), 1, 8),
                  16, 10).cast("bigint")


def md5_bucket(value, n: int) -> Column:
    """Bucket in [0, n) from the md5 prefix (hashing-trick index)."""
    return (md5_int(value) % F.lit(n)).cast("int")


def md5_unit(value) -> Column:
    """Uniform-looking number in [0, 1) from the md5 prefix."""
    return md5_int(value) / F.lit(4294967296.0)
