"""Operator 13, prefix trie of conversations by a splitter skeleton.

A conversation is a path: one 128-bit key per turn (of its SHA-256 over role
and text, the role with its length before it), and the bytes of its text.
Paths are cut into ranges by splitters, (path, conv_id) pairs taken at even
distances from a sample, so that equal paths may be cut apart too.  The trie
of the splitter paths, the skeleton, is broadcast.  A node that is not in
the skeleton has all its members in one range: its shard, sorted, finishes
it.  Of a skeleton node each shard returns a partial aggregate (least member,
members, finished children, leaves and savings below them, and its list of
ended conversations in blocks); these are reduced by node, and subtree sums
run up the skeleton.

Scale: ranges have about ``SHARD_TURNS`` turns; the skeleton is kept below
``SKELETON_NODES`` nodes (about 40 bytes each) by taking fewer splitters, so
the broadcast has a fixed bound.  Only keys and lengths are shuffled, never
texts.  Beyond the ranges that the skeleton allows (about 58,000 for
conversations of eight turns) the ranges grow.  A third of all conversations may be equal: their path is a skeleton
path, cut by conv_id into as many shards as it needs, and the list of its
ends reaches its hash in blocks of ``BLOCK`` bytes (a SHA-256 is sequential).
One conversation is one row of 24 bytes a turn.

Defined results: rows with a null conv_id belong to no conversation; a null
turn comes first, rows of one turn in the order of role and key; null role
or text is empty; repeated rows are turns of their own; turnless rebuilt
conversations belong to the root alone; an empty table has no nodes; extra
columns are not read; texts are hashed whole, however long.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import arrow_session, materialize

SHARD_TURNS = 1 << 14         # turns of a range, about
SKELETON_NODES = 1 << 21      # of the broadcast trie, at most
SAMPLE = 32                   # conversations sampled per range
BLOCK = 1 << 20               # bytes of a list of ends that travel together
KEY = 16                      # bytes of a turn in a path
SHARE, HASHES = 5, 9          # conversations that share a start; turns it may have


# ---- paths -----------------------------------------------------------------------

def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): of every conversation its turns' keys, joined,
    and the UTF-8 bytes of their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role.cast("binary")).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), role.alias("role"),
                 F.unhex(F.substring(digest, 1, 2 * KEY)).alias("key"),
                 F.octet_length(text).cast("long").alias("size")).alias("t"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda t: t["key"]).alias("keys"),
                       F.transform("t", lambda t: t["size"]).alias("sizes"))


def rebuilt(own: DataFrame) -> DataFrame:
    """The conversations with the start of conversation c - c % 5 in front of
    what follows their own first h turns, h = crc32(c) % 9."""
    c = F.col("conv_id")
    start = own.select(c.alias("base"), F.slice("keys", 1, HASHES - 1).alias("first_keys"),
                       F.slice("sizes", 1, HASHES - 1).alias("first_sizes"))
    rows = own.select("*", (c - c % SHARE).alias("base"),
                      (F.crc32(c.cast("string").cast("binary")) % HASHES).cast("int").alias("h")).join(start, "base", "left")

    def spliced(first: str, mine: str, kind: str) -> Column:
        none = F.array().cast(kind)
        tail = F.when(F.size(mine) > F.col("h"), F.slice(mine, F.col("h") + 1, F.size(mine))).otherwise(none)
        return F.concat(F.coalesce(F.slice(first, F.lit(1), F.col("h")), none), tail)

    return rows.select("conv_id", spliced("first_keys", "keys", "array<binary>").alias("keys"),
                       spliced("first_sizes", "sizes", "array<bigint>").alias("sizes"))


def joined(keys: str) -> Column:
    # keys of one length: the order of the joined paths is that of the lists
    return F.unhex(F.array_join(F.transform(keys, F.hex), ""))


# ---- skeleton --------------------------------------------------------------------

class Skeleton:
    """The trie of the sorted splitters' paths.  ``nodes[k]`` numbers the
    nodes on the path of splitter k; node 0 is the root, and a node's number
    is larger than its parent's.

    A shard's rows share skeleton nodes with the splitters at its two ends
    only: a node that also holds a splitter further away holds the one
    between."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters, self.nodes, self.n_nodes = splitters, [], 1
        before, path_nodes = b"", np.zeros(0, np.int64)
        for path, _ in splitters:
            same = _common(before, path)
            new = np.arange(self.n_nodes, self.n_nodes + len(path) // KEY - same)
            path_nodes = np.concatenate([path_nodes[:same], new])
            self.nodes.append(path_nodes)
            self.n_nodes += len(new)
            before = path

    def parents(self) -> list[int]:
        parent = [-1] * self.n_nodes
        for nodes in self.nodes:
            up = 0
            for node in nodes.tolist():
                parent[node], up = up, node
        return parent

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def near(self, shard: int) -> dict[tuple[int, bytes], int]:
        """(node, key) to child, on the paths of a shard's two splitters."""
        child = {}
        for k in (shard - 1, shard):
            if 0 <= k < len(self.splitters):
                at, path = 0, self.splitters[k][0]
                for i, node in enumerate(self.nodes[k].tolist()):
                    child[at, path[i * KEY:(i + 1) * KEY]] = node
                    at = node
        return child


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    n = min(len(a), len(b)) // KEY
    if a[:n * KEY] == b[:n * KEY]:
        return n
    same = 0
    while a[same * KEY:(same + 1) * KEY] == b[same * KEY:(same + 1) * KEY]:
        same += 1
    return same


def choose_splitters(rows: DataFrame, turns: int, n: int) -> list[tuple[bytes, int]]:
    """At even distances in a sample by hash of ``SAMPLE`` conversations per
    range; fewer, if their paths would make too large a skeleton."""
    ranges = max(1, math.ceil(turns / SHARD_TURNS))
    if ranges == 1 or not n:
        return []
    # of a skeleton of so many nodes, splitters of mean length
    ranges = min(ranges, max(2, int(SKELETON_NODES / (4 * (turns / n + 1)))))
    share = min(1.0, ranges * SAMPLE / n)
    sample = rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    place = F.ntile(ranges).over(Window.orderBy("path", "conv_id"))
    heads = sample.select("path", "conv_id").withColumn("range", place).groupBy("range").agg(F.min(F.struct("path", "conv_id")).alias("s"))
    got = sorted((bytes(r["s"]["path"]), r["s"]["conv_id"]) for r in heads.where("range > 1").collect())
    while sum(len(p) // KEY for p, _ in got) > SKELETON_NODES:
        got = got[1::2]
    return got


# ---- one shard ---------------------------------------------------------------------

_OUT = pa.schema([("kind", pa.string()), ("node", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                  ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                  ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("size", pa.int64()),
                  ("ends", pa.binary()), ("ends_sha256", pa.string())])
_OUT_DDL = ("kind string, node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, size long, ends binary, ends_sha256 string")


class _Node:
    __slots__ = ("conv_id", "n_convs", "n_children", "n_leaves", "saved", "size", "depth", "skeleton", "ends", "parent")

    def __init__(self, parent, size: int, depth: int, skeleton: int | None):
        self.parent, self.size, self.depth, self.skeleton = parent, size, depth, skeleton
        self.conv_id, self.n_convs, self.n_children, self.n_leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []


def _shard_nodes(rows: list[tuple[bytes, int, list[int]]], child: dict[tuple[int, bytes], int]) -> list[_Node]:
    """The nodes of a shard's sorted rows, in preorder."""
    nodes = [_Node(None, 0, 0, 0)]
    stack, before = [nodes[0]], b""
    for path, conv_id, sizes in rows:
        depth = len(path) // KEY
        same = _common(before, path)
        del stack[same + 1:]
        for d in range(same, depth):
            up = stack[-1]
            known = None if up.skeleton is None else child.get((up.skeleton, path[d * KEY:(d + 1) * KEY]))
            stack.append(_Node(up, sizes[d], d + 1, known))
            nodes.append(stack[-1])
        for node in stack:
            node.n_convs += 1
            if node.conv_id is None or conv_id < node.conv_id:
                node.conv_id = conv_id
        stack[-1].ends.append(conv_id)        # sorted, as the rows are
        before = path
    for node in reversed(nodes):
        if node.skeleton is not None:
            continue
        node.n_leaves = node.n_leaves if node.n_children else 1
        node.saved += (node.n_convs - 1) * node.size
        up = node.parent
        up.n_children += 1
        up.n_leaves += node.n_leaves
        up.saved += node.saved
    return nodes


def _ends(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def _shard_rows(rows: list[tuple[bytes, int, list[int]]], child: dict[tuple[int, bytes], int]) -> Iterator[tuple]:
    for node in _shard_nodes(rows, child):
        if node.skeleton is None:
            up = node.parent
            yield ("node", up.skeleton, node.conv_id, node.depth, up.conv_id if up.skeleton is None else None,
                   node.n_convs, node.n_children, node.n_leaves, node.saved, node.size, None,
                   hashlib.sha256(_ends(node.ends)).hexdigest())
        elif node.n_convs:
            yield ("part", node.skeleton, node.conv_id, node.depth, None, node.n_convs, node.n_children,
                   node.n_leaves, node.saved, node.size, None, None)
            step = BLOCK // 8
            for i in range(0, len(node.ends), step):
                some = node.ends[i:i + step]
                yield ("ends", node.skeleton, some[0], node.depth, None, None, None, None, None, None, _ends(some), None)


_NODES_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
              "saved_tokens long, ends_sha256 string")


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(_OUT)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


# ---- the trie ------------------------------------------------------------------------

def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's blocks, which come sorted."""
    node, sha = None, None
    for batch in batches:
        for n, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n != node:
                if node is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([sha.hexdigest()])], names=["node", "sha"])
                node, sha = n, hashlib.sha256(block)
            else:
                sha.update(b"," + block)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([sha.hexdigest()])], names=["node", "sha"])


def _reduce(parts: pa.Table, parent: list[int]) -> pa.Table:
    """The skeleton's nodes from their summed parts, children before parents."""
    parts = parts.sort_by("node")             # every node has members: row i is node i
    p = {c: parts.column(c).to_pylist() for c in parts.column_names}
    children, leaves, saved = p["n_children"], p["n_leaves"], p["saved_tokens"]
    for node in range(len(parent) - 1, -1, -1):
        leaves[node] = leaves[node] if children[node] else 1
        saved[node] += (p["n_convs"][node] - 1) * p["size"][node]
        if node:
            up = parent[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    p["parent_conv_id"] = [None] + [p["conv_id"][up] for up in parent[1:]]
    return pa.table({c: pa.array(v, pa.int64()) for c, v in p.items()})


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256): one row per node."""
    spark = arrow_session(conversations)
    rows = rebuilt(materialize(paths(conversations), "paths")).select("conv_id", joined("keys").alias("path"), "sizes")
    rows = materialize(rows, "rebuilt")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("path") / KEY + 1).alias("turns")).first()
    skeleton = Skeleton(choose_splitters(rows, int(size["turns"] or 0), size["n"]))
    shared = spark.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, path = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shards = [shared.value.shard(p, c) for p, c in zip(path, ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int64())],
                                             names=["conv_id", "path", "sizes", "shard"])

    def finish(t: pa.Table) -> pa.Table:
        held = sorted(zip(t.column("path").to_pylist(), t.column("conv_id").to_pylist(), t.column("sizes").to_pylist()),
                      key=lambda r: r[:2])
        return _table(list(_shard_rows(held, shared.value.near(t.column("shard")[0].as_py()))))

    dealt = rows.mapInArrow(deal, "conv_id long, path binary, sizes array<bigint>, shard long")
    out = materialize(dealt.groupBy("shard").applyInArrow(finish, _OUT_DDL), "shards")
    parts = out.where("kind = 'part'").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("size").alias("size"))
    if not size["n"]:
        return spark.createDataFrame([], _NODES_DDL)
    # bounded like the skeleton, whose trie the driver holds already
    spine = spark.createDataFrame(_reduce(parts.toArrow(), skeleton.parents()))
    ends = (out.where("kind = 'ends'").select("node", "ends", "conv_id").repartition("node")
            .sortWithinPartitions("node", "conv_id").select("node", "ends"))
    ends = ends.mapInArrow(_hash_ends, "node long, sha string")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spine = spine.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("sha", F.sha2(F.lit(b""), 256)))
    spine = materialize(spine, "skeleton")
    top = spine.select("node", F.col("conv_id").alias("up"))
    rest = out.where("kind = 'node'").drop("ends").join(top, "node", "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up"))
    return spine.select(columns).union(rest.select(columns))


ORACLE = """
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 5 AS b FROM t),
z AS (SELECT range AS n, list_reduce(list_prepend(CAST(range AS UBIGINT), range(8)),
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END) AS x FROM range(256)),
m AS (SELECT list(x ORDER BY n) AS crc FROM z),
h AS (SELECT c, b, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''),
        lambda d: CAST(ascii(d) AS UBIGINT))), lambda x, d: xor(x >> 8, crc[CAST(xor(x, d) & 255 AS BIGINT) + 1])),
        CAST(4294967295 AS UBIGINT)) % 9 AS h FROM c, m),
n AS (SELECT h.c, h.h, count(t.i) AS n FROM h LEFT JOIN t ON t.conv_id = h.b AND t.i <= h.h GROUP BY ALL),
r AS (SELECT h.c, t.i AS d, role, text FROM h JOIN t ON t.conv_id = h.b AND t.i <= h.h
      UNION ALL
      SELECT n.c, n.n + t.i - n.h, role, text FROM n JOIN t ON t.conv_id = n.c AND t.i > n.h),
k AS (SELECT c, d, strlen(text) AS bytes, sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (
        PARTITION BY c ORDER BY d)) AS key FROM r
      UNION ALL SELECT c, 0, 0, '' FROM c),
e AS (SELECT c, d, key, d = max(d) OVER (PARTITION BY c) AS last, bytes, lag(key) OVER (PARTITION BY c ORDER BY d) AS up FROM k),
g AS (SELECT key, d AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
      FROM e GROUP BY key, d),
ch AS (SELECT up, count(*) AS n FROM g WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT a.key, sum((g.n_convs - 1) * g.bytes) AS saved, count(*) FILTER (WHERE ch.n IS NULL) AS leaves
      FROM g JOIN e a ON a.c = g.conv_id AND a.d <= g.depth LEFT JOIN ch ON ch.up = g.key GROUP BY a.key)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(ch.n, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN s USING (key) LEFT JOIN g p ON p.key = g.up LEFT JOIN ch ON ch.up = g.key"""
