"""Frequent tag sets and association rules."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.constants import FP_MIN_CONFIDENCE, FP_MIN_SUPPORT
from forumlens.session import materialize


def render_items(items) -> F.Column:
    """``[a,b,c]`` with the items in sorted order (stable across runs)."""
    c = F.col(items) if isinstance(items, str) else items
    return F.concat(F.lit("["), F.array_join(F.array_sort(c), ","), F.lit("]"))


class FrequentPatterns:
    """What ``fit_fpgrowth`` found in ``n`` baskets: ``freqItemsets (items,
    freq)``, and ``associationRules`` with one consequent, as Spark's
    ``FPGrowthModel`` has them."""

    def __init__(self, freqItemsets: DataFrame, n: int, min_confidence: float):
        self.freqItemsets, self.n, self.min_confidence = freqItemsets, n, min_confidence

    @property
    def associationRules(self) -> DataFrame:
        sets = self.freqItemsets
        rules = sets.where(F.size("items") > 1).select(F.posexplode("items").alias("pos", "item"), "items", "freq").select(
            F.filter("items", lambda x, i: i != F.col("pos")).alias("antecedent"), F.array("item").alias("consequent"), "freq")
        rules = (rules.join(sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_a")), "antecedent")
                 .join(sets.select(F.col("items").alias("consequent"), F.col("freq").alias("_c")), "consequent"))
        confidence = F.col("freq") / F.col("_a")
        return rules.where(confidence >= self.min_confidence).select(
            "antecedent", "consequent", confidence.alias("confidence"),
            (confidence / (F.col("_c") / F.lit(self.n))).alias("lift"), (F.col("freq") / F.lit(self.n)).alias("support"))


def _extended(rows: DataFrame) -> DataFrame:
    """Every row's set with each item of its ``rest``, and what follows that item."""
    return rows.select("set", F.posexplode("rest").alias("_pos", "item"), "rest").select(
        "set", "item", F.slice("rest", F.col("_pos") + 2, F.size("rest")).alias("rest"))


def fit_fpgrowth(baskets: DataFrame, items: str = "items",
                 min_support: float = FP_MIN_SUPPORT,
                 min_confidence: float = FP_MIN_CONFIDENCE,
                 num_partitions: int | None = None) -> FrequentPatterns:
    """M6: frequent itemsets by pattern growth over projected baskets.

    A frequent set's projection is, for each basket that holds it, the items
    after its last one; counting those gives the sets that are one item
    longer.  All sets of a size are counted together, in one grouped
    aggregation whose partial counts are as few as the sets; no tree of a
    group's baskets is held or shuffled.  The frequent items of each basket
    are staged and read once per size.  The frequent sets pass through the
    driver: of size k at most (k-item subsets of an average basket) /
    ``min_support``, however many baskets there are.

    Duplicate items in a basket are removed first (a post may repeat a tag);
    null baskets do not count.  ``num_partitions`` defaults to the input's
    partitioning instead of the reference's single partition.
    """
    b = baskets.select(F.sort_array(F.array_distinct(F.col(items))).alias("rest")).where(F.col("rest").isNotNull())
    if num_partitions:
        b = b.repartition(num_partitions)
    spark, kind = baskets.sparkSession, b.schema["rest"].dataType
    n = b.count()
    least = math.ceil(min_support * n)
    rows, sets, found = b.select(F.lit(0).alias("set"), "rest"), {0: ()}, []
    while True:
        longer = _extended(rows)
        counts = longer.groupBy("set", "item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least).collect()
        if not counts:
            break
        sets = {i: (*sets[r["set"]], r["item"]) for i, r in enumerate(counts)}
        found += [(list(sets[i]), r["freq"]) for i, r in enumerate(counts)]
        if len(sets[0]) == 1:       # nothing holds the other items
            named, null = [r["item"] for r in counts if r["item"] is not None], F.lit(any(r["item"] is None for r in counts))
            rest = F.filter("rest", lambda x: F.coalesce(x.isin(named), null))
            rows = materialize(rows.select("set", rest.alias("rest")).where(F.size("rest") > 1), "frequent-items")
            longer = _extended(rows)
        known = spark.createDataFrame([(r["set"], r["item"], i) for i, r in enumerate(counts)],
                                      T.StructType([T.StructField("_set", T.IntegerType()), T.StructField("_item", kind.elementType),
                                                    T.StructField("_id", T.IntegerType())]))
        rows = longer.where(F.size("rest") > 0).join(
            F.broadcast(known), (F.col("set") == F.col("_set")) & F.col("item").eqNullSafe(F.col("_item"))).select(
            F.col("_id").alias("set"), "rest")
    out = spark.createDataFrame(found, T.StructType([T.StructField("items", kind), T.StructField("freq", T.LongType())]))
    return FrequentPatterns(out, n, min_confidence)


def frequent_itemsets(model) -> DataFrame:
    """``(items, size, freq)`` with items rendered ``[a,b]``."""
    f = model.freqItemsets
    return f.select(render_items("items").alias("items"),
                    F.size("items").alias("size"), F.col("freq"))


def association_rules(model, digits: int = 10) -> DataFrame:
    """M7: ``(antecedent, consequent, confidence, lift, support)``."""
    r = model.associationRules
    return r.select(render_items("antecedent").alias("antecedent"),
                    render_items("consequent").alias("consequent"),
                    F.round("confidence", digits).alias("confidence"),
                    F.round("lift", digits).alias("lift"),
                    F.round("support", digits).alias("support"))
