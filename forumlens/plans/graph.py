"""User-tag graph queries on events (user x event type as tags)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.operators import graph as G
from forumlens.operators.scores import user_tag_score
from forumlens.plans import sql
from forumlens.plans.registry import query
from forumlens.session import shared_path
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt
from forumlens.sources import sinks

K = G.PIC_K
STEPS = G.PIC_MAX_ITER      # as many as the reference iterates at most
MAX_ITER = G.PIC_MAX_ITER

_EDGES = f"""t AS (SELECT CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS Id,
                  event_type AS TagName FROM (SELECT DISTINCT event_type FROM events)),
e AS (SELECT user_id * 2 AS src, t.Id * 2 + 1 AS dst, abs(sum(value)) AS weight
      FROM events JOIN t ON event_type = t.TagName GROUP BY user_id, t.Id)"""


def _power_ctes(steps: int, edges: str = _EDGES) -> str:
    parts = [f"""{edges},
sym AS (SELECT src, dst, weight FROM e UNION ALL SELECT dst, src, weight FROM e),
deg AS (SELECT src AS id, sum(weight) AS d FROM sym GROUP BY src),
a AS (SELECT sym.src, sym.dst, weight / d AS a FROM sym JOIN deg ON sym.src = deg.id),
v0 AS (SELECT id, d / (SELECT sum(d) FROM deg) AS v FROM deg)"""]
    for i in range(1, steps + 1):
        parts.append(f"""n{i} AS (SELECT a.src AS id, sum(a.a * v{i-1}.v) AS v
        FROM a JOIN v{i-1} ON a.dst = v{i-1}.id GROUP BY a.src),
v{i} AS (SELECT id, v / (SELECT sum(abs(v)) FROM n{i}) AS v FROM n{i})""")
    return "WITH " + ",\n".join(parts)


def _power_sql(steps: int, edges: str = _EDGES) -> str:
    return f"{_power_ctes(steps, edges)}\nSELECT id, round(v, 10) AS v FROM v{steps}"


def _cluster_ctes(steps: int, edges: str = _EDGES, k: int = G.PIC_K, rounds: int = G.KMEANS_ROUNDS) -> str:
    """k-means on the vector: ``cl`` (id, cluster)."""
    v = "emb"
    parts = [_power_ctes(steps, edges), f"""emb AS MATERIALIZED (
  SELECT id, round(v * count(*) OVER (), {G.EMBEDDING_DIGITS}) AS v FROM v{steps})""", f"""dv AS (SELECT v, row_number() OVER (ORDER BY v) AS p, count(*) OVER () AS n FROM (SELECT DISTINCT v FROM {v})),
c0 AS (SELECT list(v ORDER BY v) AS c FROM dv WHERE p IN ({', '.join(f'((2 * {i} + 1) * n) // (2 * {k}) + 1' for i in range(k))}))"""]
    nearest = " + ".join(f"coalesce(CAST(v > (c[{i}] + c[{i + 1}]) / 2 AS INTEGER), 0)" for i in range(1, k))
    for i in range(1, rounds + 1):
        parts.append(f"""a{i} AS (SELECT {nearest} AS j, avg(v) AS m FROM {v}, c{i-1} GROUP BY 1),
c{i} AS MATERIALIZED (SELECT list(coalesce(m, c[j + 1]) ORDER BY j) AS c FROM c{i-1}, range({k}) r(j) LEFT JOIN a{i} USING (j))""")
    return ",\n".join(parts) + f",\ncl AS (SELECT id, {nearest} AS cluster FROM {v}, c{rounds})"


def edges(spark, sf):
    return G.pic_edges(fx.event_user_tag(spark, sf), fx.event_tags(spark, sf))


@query("pic_edges", f"""WITH {_EDGES}
SELECT src, dst, round(weight, 6) AS weight FROM e""")
def pic_edges(spark, sf):
    return edges(spark, sf).select("src", "dst", F.round("weight", 6).alias("weight"))


@query("power_iteration_vector", _power_sql(STEPS))
def power_iteration_vector(spark, sf):
    v = G.power_iteration_vector(edges(spark, sf), STEPS)
    return v.select("id", F.round("v", 10).alias("v"))


@query("pic_assign", f"{_cluster_ctes(STEPS)}\nSELECT id, cluster FROM cl")
def pic_assign(spark, sf):
    """M8 on the events graph, clusters numbered by their place on the vector."""
    return G.communities(edges(spark, sf), K, STEPS)


@query("cluster_tags", f"""{_cluster_ctes(STEPS)}
SELECT cluster, string_agg(TagName, ',' ORDER BY TagName) AS tags
FROM cl JOIN t ON cl.id = t.Id * 2 + 1 GROUP BY cluster""")
def cluster_tags(spark, sf):
    """P11 + J5 + A6: each cluster's tags by name, users left out."""
    a = G.communities(edges(spark, sf), K, STEPS)
    return G.cluster_tags(a, fx.event_tags(spark, sf)).select(
        "cluster", F.array_join("tags", ",").alias("tags"))


@query("pic_estimator")
def pic_estimator(spark, sf):
    """M8 with Spark's own estimator, whose random start SQL can't follow."""
    return G.pic_assign(edges(spark, sf), K, MAX_ITER)


_UTS_EDGES = f"""{sql.USER_TAG_SCORE_CTE},
t AS (SELECT CAST(row_number() OVER (ORDER BY TagId) AS BIGINT) AS Id, TagId AS TagName
      FROM (SELECT DISTINCT TagId FROM uts)),
e AS (SELECT UserId * 2 AS src, t.Id * 2 + 1 AS dst, abs(TotalScore) AS weight
      FROM uts JOIN t ON uts.TagId = t.TagName)"""


def _uts_graph(spark, sf):
    """The scores -> communities hand-off: user-tag scores written as CSV in
    the shared folder (real CSV, T9), read back as string triples, tag names
    mapped to ids through the tags vocabulary.  Returns edges and tags."""
    path = shared_path(spark, "uts-csv")
    sinks.write_user_tag_csv(user_tag_score(fx.qa_posts(spark, sf)), path)
    triples = fmt.read_user_tag_csv(spark, path)
    tags = fx.with_ids(triples.select(F.col("TagId").alias("TagName")).distinct())
    return G.pic_edges(triples.select(F.col("UserId").cast("bigint").alias("UserId"),
                                      "TagId", F.col("Score").cast("double").alias("Score")),
                       tags), tags


@query("uts_power_iteration", _power_sql(STEPS, _UTS_EDGES))
def uts_power_iteration(spark, sf):
    """The power-iteration vector of the user-tag scores."""
    v = G.power_iteration_vector(_uts_graph(spark, sf)[0], STEPS)
    return v.select("id", F.round("v", 10).alias("v"))


@query("uts_cluster_tags", f"""{_cluster_ctes(STEPS, _UTS_EDGES)}
SELECT cluster, string_agg(TagName, ',' ORDER BY TagName) AS tags
FROM cl JOIN t ON cl.id = t.Id * 2 + 1 GROUP BY cluster""")
def uts_cluster_tags(spark, sf):
    """The whole chain: posts, user-tag scores, CSV, graph, communities, and
    each community's tags."""
    edges_, tags = _uts_graph(spark, sf)
    return G.cluster_tags(G.communities(edges_, K, STEPS), tags).select(
        "cluster", F.array_join("tags", ",").alias("tags"))
