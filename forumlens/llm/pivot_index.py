"""Operator 8, embedding near-dedup with a pivot-permutation index.

A vector is described by its ``PREFIX`` nearest reference points (pivots) in
order.  Inverted lists hold the vectors of each two pivots of the prefix, so
two vectors meet in such a list exactly if they share at least two pivots;
their cosine is then verified in double precision.  A pair that shares
several lists is counted in the list of its two smallest shared pivots only.

A vector whose nearest pivot has at least the cosine ``spread`` (that of
twice the link's angle) is at home there; all vectors of one home meet in its
own list, whatever the rest of their prefixes, and are counted there only.
Pivots are further apart than that from each other, so all vectors that link
to a pivot are at home there: within a group of near copies around a pivot no
link is lost.

Equal vectors are one class with a multiplicity, so copies meet once.  A list
longer than ``LIST_BLOCK`` is cut into blocks and each two blocks meet in a
task of their own: no list is cut off.  Tasks return per-vector link counts
and links to the smallest partner of a local component, never all pairs.

The pivots are vectors of the table (up to ``pivot_count`` of them: about the
square root of the number of classes, between 64 and 4096).  Of the
``CANDIDATES`` times as many with the smallest hash, those are taken in turn
that are not within the cosine ``spread`` of an earlier one, so a large group
of near copies supplies one pivot, not its share of them, and the choice does
not depend on the layout.

Defined results: null and zero vectors and those with null or non-finite
components have no links and are their own component; vectors of different
length never link; a null vec_id takes part in links but names no component;
repeated rows are copies of each other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import arrow_session, connected_components, materialize

COSINE = 0.95
PREFIX = 6                   # pivots that describe a vector
LIST_BLOCK = 1024            # vectors of a list compared at once
CANDIDATES = 2               # vectors looked at for each pivot


def pivot_count(classes: int) -> int:
    return int(min(4096, max(64, 2 ** round(np.log2(max(classes, 1)) / 2))))


def unit(column) -> np.ndarray:
    """Rows of equal length as double-precision unit vectors."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spread(cosine: float) -> float:
    """The cosine of twice the angle of a link, 0.5 at least."""
    return max(2 * cosine * cosine - 1, 0.5)


def spread_out(x: np.ndarray, count: int, least: float) -> np.ndarray:
    """The first ``count`` rows that have a cosine below ``least`` with all
    rows taken before them."""
    taken = np.empty((0, x.shape[1]))
    for lo in range(0, len(x), 256):
        part = x[lo:lo + 256]
        part = part[(part @ taken.T < least).all(1)]
        near = part @ part.T >= least
        mine: list[int] = []
        for k in range(len(part)):
            if not near[k, mine].any():
                mine.append(k)
        taken = np.concatenate([taken, part[mine]])
        if len(taken) >= count:
            break
    return taken[:count]


def _prefixes(pivots, least: float):
    """Sorted prefix (pivot numbers) of every vector; the order of nearness
    breaks ties by pivot number.  ``home`` is the nearest pivot if its cosine
    is at least ``least``, else -1."""
    def run(batches):
        p = pivots.value
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                cos = unit(part.column(1)) @ p.T
                near = np.argsort(-cos, axis=1, kind="stable")[:, :PREFIX]
                home = np.where(cos[np.arange(len(cos)), near[:, 0]] >= least, near[:, 0], -1)
                near.sort(axis=1)
                k = near.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2),
                     pa.ListArray.from_arrays(np.arange(0, len(near) * k + 1, k, dtype=np.int32),
                                              near.astype(np.int32).ravel()),
                     pa.array(home.astype(np.int32))],
                    names=["cid", "v", "m", "prefix", "home"])
    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links i-j, per index."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["cid"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        cid, m = table["cid"].to_numpy(), table["m"].to_numpy()
        side = table["side"].to_numpy()
        p = table["p"][0].as_py()
        x = unit(table["v"])
        prefix = table["prefix"].combine_chunks().flatten().to_numpy().reshape(len(cid), -1)
        home = table["home"].to_numpy()
        two = table["two"][0].as_py()
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1) if two else a
        found_i, found_j = [], []
        for lo in range(0, len(a), 512):
            i, j = np.nonzero(x[a[lo:lo + 512]] @ x[b].T >= least - 1e-9)
            i, j = a[i + lo], b[j]
            on = i != j if two else i < j
            found_i.append(i[on])
            found_j.append(j[on])
        i = np.concatenate(found_i) if found_i else np.empty(0, np.int64)
        j = np.concatenate(found_j) if found_j else np.empty(0, np.int64)
        links, own, at = np.zeros(len(cid), np.int64), np.zeros(len(cid), bool), slice(0, 0)
        keep_i, keep_j = [], []
        for lo in range(0, len(i), 65536):          # one rounding for every pair
            at = slice(lo, lo + 65536)
            u, w = i[at], j[at]
            on = (x[u] * x[w]).sum(1) >= least
            u, w = u[on], w[on]
            keep_i.append(u)
            keep_j.append(w)
            if p[0] == p[1]:                        # the list of a home
                mine = np.ones(len(u), bool)
            else:                                   # the two smallest shared pivots of each pair
                shared = (prefix[u][:, :, None] == prefix[w][:, None, :]).any(2)
                rank = np.cumsum(shared, axis=1)
                first = prefix[u, (shared & (rank == 1)).argmax(1)]
                second = prefix[u, (shared & (rank == 2)).argmax(1)]
                mine = (first == p[0]) & (second == p[1]) & ((home[u] != home[w]) | (home[u] < 0))
            np.add.at(links, u[mine], m[w[mine]])
            np.add.at(links, w[mine], m[u[mine]])
        if keep_i:
            i, j = np.concatenate(keep_i), np.concatenate(keep_j)
        else:
            i = j = np.empty(0, np.int64)
        root = cid[_roots(len(cid), i, j)]
        some = np.flatnonzero((links > 0) | (root != cid))
        return pa.table({"cid": cid[some], "links": links[some], "root": root[some]})
    return run


def _valid() -> object:
    v = F.col("v")
    return (F.coalesce(F.size(v) > 0, F.lit(False))
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def near_duplicates(embeddings: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding",
                    cosine: float = COSINE, list_block: int = LIST_BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = arrow_session(embeddings)
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.withColumn("ok", _valid())
    classes = (rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("m"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = materialize(classes, "classes")
    dims = classes.groupBy(F.size("v").alias("dim")).count().collect()     # one row per vector length
    stats = None
    for d in sorted(dims):
        part = _links(spark, classes.where(F.size("v") == d["dim"]), pivot_count(d["count"]), cosine, list_block)
        stats = part if stats is None else stats.union(part)
    if stats is None:
        stats = spark.createDataFrame([], "cid long, links long, root long")
    stats = materialize(stats, "links")
    counts = stats.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = connected_components(stats.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    known = (classes.join(counts, "cid", "left")
             .join(comps.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("comp", F.coalesce("comp", "cid")))
    known = known.join(known.groupBy("comp").agg(F.min("least").alias("component_id")), "comp")
    known = known.select("v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    good = rows.where("ok").join(known, "v").select("vec_id", "n_links", "component_id")
    bad = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(spark, classes: DataFrame, pivots: int, cosine: float, list_block: int) -> DataFrame:
    chosen = (classes.orderBy(F.xxhash64("v"), "cid").limit(CANDIDATES * pivots).select("v").toArrow())   # bounded
    least = spread(cosine)
    p = spark.sparkContext.broadcast(spread_out(unit(chosen["v"]), pivots, least))
    few = min(PREFIX, len(p.value))
    described = materialize(classes.select("cid", "v", "m").mapInArrow(
        _prefixes(p, least if few > 1 else -2.0),    # a single pivot: one list
        f"cid long, v {classes.schema['v'].dataType.simpleString()}, m long, prefix array<int>, home int"),
        "prefixes")
    pairs = [F.array(F.col("prefix")[i], F.col("prefix")[j]) for i in range(few) for j in range(i + 1, few)]
    pairs.append(F.when(F.col("home") >= 0, F.array("home", "home")))
    entry = described.select("cid", "home", F.explode(F.array_compact(F.array(*pairs))).alias("p"))
    # vectors of one home meet in its own list, so other lists need two homes
    blocks = (entry.groupBy("p").agg(F.count("*").alias("n"), F.min("home").alias("x"), F.max("home").alias("y"))
              .where("n > 1 and (p[0] = p[1] or x <> y or x < 0)")
              .select("p", F.ceil(F.col("n") / F.lit(list_block)).alias("blocks")))
    entry = entry.drop("home").join(blocks, "p").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    entry = entry.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    entry = entry.select(
        "cid", "p", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"),
        (F.col("block") > F.col("o")).cast("int").alias("side"), (F.col("block") != F.col("o")).alias("two"))
    return entry.join(described, "cid").groupBy("p", "lo", "hi").applyInArrow(
        _compare(cosine), "cid long, links long, root long")
