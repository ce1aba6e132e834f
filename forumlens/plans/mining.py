"""Frequent-pattern queries over order baskets (distinct part names)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.operators import mining as MN
from forumlens.plans.registry import query
from forumlens.session import materialize, shared_path
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt

# Fixture parameters: at support 0.01 no pair is frequent in these baskets
# (64 single items, 0 pairs); 0.003 gives 64 items and 1520 pairs.
MIN_SUPPORT = 0.003
MIN_CONFIDENCE = 0.08

_BASKETS = """b AS (SELECT DISTINCT l_orderkey AS id, p_name AS item
            FROM lineitem JOIN part ON l_partkey = p_partkey),
nb AS (SELECT count(DISTINCT id) AS n FROM b),
mc AS (SELECT CAST(ceil({s} * n) AS BIGINT) AS m, n FROM nb),
f1 AS (SELECT item FROM b GROUP BY item HAVING count(*) >= (SELECT m FROM mc)),
bf AS (SELECT id, item FROM b WHERE item IN (SELECT item FROM f1)),
subsets(id, items, last) AS (
  SELECT id, [item], item FROM bf
  UNION ALL
  SELECT s.id, list_append(s.items, bf.item), bf.item
  FROM subsets s JOIN bf ON bf.id = s.id AND bf.item > s.last),
fi AS (SELECT items, count(*) AS freq FROM subsets GROUP BY items
       HAVING count(*) >= (SELECT m FROM mc))""".format(s=MIN_SUPPORT)


def _render(col: str) -> str:
    return f"'[' || array_to_string({col}, ',') || ']'"


@query("basket_parse", """SELECT id AS basket_id, CAST(pos AS INTEGER) AS pos, item FROM (
  SELECT id, unnest(generate_series(0, len(t) - 1)) AS pos, unnest(t) AS item FROM (
    SELECT id, string_split(trim(array_to_string(list_sort(list(DISTINCT item)), ' ')), ' ') AS t
    FROM (SELECT l_orderkey AS id, p_name AS item FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY id))""")
def basket_parse(spark, sf):
    """Baskets written as space-separated lines, parsed back to items
    (multi-word names become separate items, as a space-split file would)."""
    b = fx.order_baskets(spark, sf)
    lines = b.select("basket_id", F.array_join("items", " ").alias("value"))
    parsed = fmt.parse_basket_lines(lines, "value")
    return parsed.select("basket_id", F.posexplode("items").alias("pos", "item"))


@query("frequent_itemsets", f"""WITH RECURSIVE {_BASKETS}
SELECT {_render('items')} AS items, CAST(len(items) AS INTEGER) AS size, freq FROM fi""")
def frequent_itemsets(spark, sf):
    # the fit reads its input more than once: join and group the baskets once
    model = MN.fit_fpgrowth(materialize(fx.order_baskets(spark, sf), "baskets"), min_support=MIN_SUPPORT,
                            min_confidence=MIN_CONFIDENCE)
    return MN.frequent_itemsets(model)


@query("association_rules", f"""WITH RECURSIVE {_BASKETS},
r AS (SELECT list_filter(items, lambda x: x <> y) AS ante, [y] AS cons, freq
      FROM (SELECT items, freq, unnest(items) AS y FROM fi WHERE len(items) >= 2))
SELECT {_render('r.ante')} AS antecedent, {_render('r.cons')} AS consequent,
       round(r.freq / fa.freq, 10) AS confidence,
       round((r.freq / fa.freq) / (fc.freq / mc.n), 10) AS lift,
       round(r.freq / mc.n, 10) AS support
FROM r JOIN fi fa ON fa.items = r.ante JOIN fi fc ON fc.items = r.cons, mc
WHERE r.freq / fa.freq >= {MIN_CONFIDENCE}""")
def association_rules(spark, sf):
    model = MN.fit_fpgrowth(materialize(fx.order_baskets(spark, sf), "baskets"), min_support=MIN_SUPPORT,
                            min_confidence=MIN_CONFIDENCE)
    return MN.association_rules(model)


@query("basket_file", """SELECT '[' || array_to_string(t, ',') || ']' AS items, count(*) AS n FROM (
  SELECT id, string_split(trim(array_to_string(list_sort(list(DISTINCT item)), ' ')), ' ') AS t
  FROM (SELECT l_orderkey AS id, p_name AS item FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY id)
GROUP BY ALL""")
def basket_file(spark, sf):
    """The baskets written as text lines in the shared folder, read back
    and counted."""
    path = shared_path(spark, "baskets")
    fx.order_baskets(spark, sf).select(fmt.basket_line()).write.text(path)
    items = F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("items")
    return fmt.read_baskets(spark, path).groupBy(items).agg(F.count(F.lit(1)).alias("n"))
