"""Splitting and sampling.

Default mode is a hash of the row id: membership does not depend on the
partition layout, so it survives re-execution after a lost executor and is
reproducible in any engine.  ``random`` mode is Spark's seeded sampler.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions.hashing import md5_unit


def _u(id_col: str, salt: str) -> F.Column:
    key = F.col(id_col).cast("string")
    return md5_unit(F.concat(key, F.lit(salt)) if salt else key)


def hash_split(df: DataFrame, id_col: str, weights=(0.7, 0.3),
               salt: str = "") -> list[DataFrame]:
    """R2: split by a hash of the id into parts with the given weights."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo, acc = acc, acc + w / total
        bounds.append((lo, acc))
    u = _u(id_col, salt)
    parts = []
    for i, (lo, hi) in enumerate(bounds):
        cond = (u >= lo) & ((u < hi) if i < len(bounds) - 1 else F.lit(True))
        parts.append(df.where(cond))
    return parts


def split_label(df: DataFrame, id_col: str, train: float = 0.7,
                salt: str = "", out: str = "split") -> DataFrame:
    """R2 as a column: ``train`` / ``test`` by hash."""
    return df.withColumn(out, F.when(_u(id_col, salt) < train, "train")
                         .otherwise("test"))


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42):
    """R2 random mode (rows chosen depend on partition layout)."""
    return df.randomSplit(list(weights), seed)


def stratified_sample(df: DataFrame, label: str, fractions: dict,
                      id_col: str | None = None, salt: str = "",
                      seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement per class.

    With ``id_col`` the draw is a hash of the id (deterministic); without it
    Spark's ``sampleBy`` is used.  Classes absent from ``fractions`` are
    dropped, as ``sampleBy`` does.
    """
    if id_col is None:
        return df.sampleBy(label, fractions, seed)
    frac = F.lit(None).cast("double")
    for k, v in fractions.items():
        frac = F.when(F.col(label) == F.lit(k), F.lit(float(v))).otherwise(frac)
    return df.where(_u(id_col, salt) < frac)
