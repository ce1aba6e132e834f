"""Operator 2, n-gram Jaccard join with signature trees.

Documents are sets of word 5-grams; two link when their Jaccard similarity is
at least ``threshold``.  The join returns each document's component.

1. Every text becomes its set of 64-bit shingle hashes.  Documents with equal
   sets form one class (128 bits of the set); only classes are joined.  A
   class is named by the first 64 bits, or, where these clash, by the others.
2. Candidate buckets: under one global order of shingles (commonest last, by a
   fixed-size count of hashed shingles), linked sets share a shingle among
   their first ``n - ceil(t n) + 1``.  One text of each class is put into
   buckets, so copies of a text meet in no task.  Buckets with a single class disappear
   in the task that gathers them; shingles that are extremely common are
   salted over several tasks.
3. Star rounds: in each bucket every class is compared with a few centres, a
   number of pairs in proportion to the bucket.  Verified links are closed
   into components; classes already connected need no comparison.  Another
   round follows while rounds settle a good part of the rows.
4. Signature trees: the classes of each bucket that still spans several
   components are put into trees.  A leaf holds a token bitmap, its set size
   and component; a node the OR of its children's bitmaps, their size range
   and their common component.  A dual traversal (the tree with itself)
   prunes every node pair whose largest possible overlap, or whose size
   ranges, cannot reach the threshold, or that lies in one component; the
   leaf pairs left are verified.  Buckets are cut into blocks of bounded size
   and the trees of each two blocks are traversed.  No pair that could link
   two components is lost.

Verification compares the texts' shingles themselves, not hashes.

Defined results: words are lower-cased A-Z and cut at ASCII white space; a
text with fewer words than a shingle is one shingle of all its words; a null,
empty or wordless text has no shingles, links with nothing and is its own
component.  A null doc_id takes part in linking but never names a component
(a class without any id has a null component).  Repeated rows are each
reported.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm import textbytes as tb
from forumlens.llm.common import arrow_session, connected_components, materialize
from forumlens.session import discard

WORDS = 5                     # words of a shingle
THRESHOLD = (4, 5)            # similarity 0.8 as a fraction
BLOCK_BYTES = 6 << 20         # text bytes shingled together
SKETCH_BITS = 20              # counters of hashed shingles
SKETCH_SLICES = 64
BUCKET_ENTRIES = 2_000_000    # prefix shingles gathered by one task
SALT_CLASS = 20               # shingles seen 2**20 times or more are salted
STAR_ROUNDS = 3               # at most
SETTLED = 0.25                # share of rows a round settles, else the trees follow
TREE_BLOCK = 512              # classes in one tree
TREE_BYTES = 16 << 20         # bitmaps compared at once
FANOUT = 8

_C = tb.mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_K1, _K2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def shingle_sets(texts, words: int = WORDS):
    """Sorted distinct 64-bit shingle hashes of each row, a list of arrays."""
    data, off = tb.text_buffer(texts)
    w = tb.split_words(data, off, tb.NONSPACE)
    enc = w.array().dictionary_encode()
    h = tb.hash_values(enc.dictionary)[enc.indices.to_numpy(zero_copy_only=False)]
    n = len(h)
    first = w.first
    with np.errstate(over="ignore"):
        s = np.zeros(max(n - words + 1, 0), np.uint64)
        for k in range(words):
            s += h[k:k + len(s)] * _C[k]
        s = tb.mix(s)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(s[a:b - words + 1]))
            elif b > a:              # shorter than a shingle: the whole sequence
                x = (h[a:b] * _C[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * _K1
                out.append(tb.mix(np.array([x], np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def class_key(s: np.ndarray, id_bits: int = 64) -> tuple[int, int]:
    """64 and another 64 bits that name a shingle set.  ``id_bits``: how many
    of the first 64 are used (tests use few, so that they clash)."""
    with np.errstate(over="ignore"):
        a = tb.mix(s ^ _K1).sum(dtype=np.uint64) >> np.uint64(64 - id_bits)
        b = tb.mix(s ^ _K2).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def bitmap(s: np.ndarray) -> bytes:
    """Token bitmap of 8 to 16 bits per shingle (a power of two, 64 at least):
    two sets that share few shingles then share few bits."""
    width = max(64, 1 << (8 * len(s) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def min_overlap(size_a, size_b, threshold=THRESHOLD):
    """Least intersection of two sets of these sizes that link."""
    p, q = threshold
    return -(-(p * (size_a + size_b)) // (p + q))


def prefix_length(n: int, threshold=THRESHOLD) -> int:
    p, q = threshold
    return n - -(-p * n // q) + 1


# ---------------------------------------------------------------- set table

def _sets(batches, id_bits=64):
    """Rows of the set table, and this task's share of the shingle counts."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for t in tb.table_slices(batches, lambda b: b.column(1), BLOCK_BYTES):
        sets = shingle_sets(t.column(1))
        counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                              minlength=len(counts)) if sets else 0
        keys = [class_key(s, id_bits) if len(s) else (None, None) for s in sets]
        yield _set_rows(len(sets), doc_id=t.column(0).combine_chunks(),
                        n=pa.array([len(s) for s in sets], pa.int64()),
                        cid=pa.array([k[0] for k in keys], pa.int64()),
                        check=pa.array([k[1] for k in keys], pa.int64()),
                        th1=t.column(2).combine_chunks(), th2=t.column(3).combine_chunks(),
                        bits=pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()))
    if counts.any():
        cut = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SKETCH_SLICES)]
        yield _set_rows(SKETCH_SLICES, slice=pa.array(range(SKETCH_SLICES), pa.int32()),
                        counts=pa.array(cut, pa.binary()))


_SET_TYPES = {"doc_id": pa.int64(), "n": pa.int64(), "cid": pa.int64(), "check": pa.int64(),
              "th1": pa.int64(), "th2": pa.int64(), "bits": pa.binary(),
              "slice": pa.int32(), "counts": pa.binary()}
_SET_DDL = ("doc_id long, n long, cid long, check long, th1 long, th2 long, bits binary, "
            "slice int, counts binary")


def _set_rows(size, **cols):
    return pa.RecordBatch.from_arrays(
        [cols[k] if k in cols else pa.nulls(size, t) for k, t in _SET_TYPES.items()],
        names=list(_SET_TYPES))


def _sum_counts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for x in table["counts"])
    return pa.table({"slice": table["slice"].slice(0, 1),
                     "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def shingle_order(sets: DataFrame) -> np.ndarray:
    """log2 of the number of shingles in each of 2**SKETCH_BITS hash cells:
    one byte each, whatever the size of the corpus.  The tasks' counts are
    added up in two steps, so that no task adds more than the square root of
    their number."""
    part = sets.where("slice is not null").select("slice", "counts")
    tasks = part.where("slice = 0").count()
    spread = F.pmod(F.xxhash64("counts"), F.lit(max(1, math.isqrt(tasks))))
    part = (part.withColumn("g", spread).groupBy("slice", "g").applyInArrow(
        _sum_counts, "slice int, counts binary")
        .groupBy("slice").applyInArrow(_sum_counts, "slice int, counts binary"))
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    width = len(out) // SKETCH_SLICES
    for row in part.collect():                       # SKETCH_SLICES rows
        out[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(
            zlib.decompress(row["counts"]), np.int64)
    return np.log2(np.maximum(out, 1)).astype(np.uint8)


# ------------------------------------------------------------------ buckets

_BLOB_DDL = "bucket long, tokens binary, counts binary, cids binary, sizes binary"


def _prefixes(order, n_buckets, threshold, id_bits, clashes):
    def run(batches):
        level = order.value
        for t in tb.table_slices(batches, lambda b: b.column(0), BLOCK_BYTES):
            tokens, cids, sizes, owner = [], [], [], []
            for s in shingle_sets(t.column(0)):
                if not len(s):
                    continue
                cls = level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                p = prefix_length(len(s), threshold)
                key = (cls.astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                take = np.argpartition(key, p - 1)[:p] if p < len(s) else np.arange(len(s))
                tokens.append(s[take])
                owner.append(np.full(p, len(cids)))
                cid, check = class_key(s, id_bits)
                cids.append(check if cid in clashes else cid)
                sizes.append(len(s))
            if not tokens:
                continue
            tok, own = np.concatenate(tokens), np.concatenate(owner)
            cid, size = np.array(cids, np.int64), np.array(sizes, np.int32)
            bucket = tb.mix(tok)
            salt = level[(tok >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64) - SALT_CLASS
            hot = np.flatnonzero(salt >= 0)
            with np.errstate(over="ignore"):
                spread = tb.mix(cid[own[hot]].astype(np.uint64)) & (
                    (np.uint64(2) << salt[hot].astype(np.uint64)) - np.uint64(1))
                bucket[hot] = tb.mix(bucket[hot] + spread)
            bucket = (bucket % np.uint64(n_buckets)).astype(np.int64)
            sort = np.lexsort((own, bucket))
            tok, own, bucket = tok[sort], own[sort], bucket[sort]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            out = [[], [], [], [], []]
            for a, b in zip(cut[:-1], cut[1:]):
                who, c = np.unique(own[a:b], return_counts=True)
                for x, y in zip(out, (int(bucket[a]), tok[a:b].tobytes(), c.astype(np.int32).tobytes(),
                                      cid[who].tobytes(), size[who].tobytes())):
                    x.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
                names=["bucket", "tokens", "counts", "cids", "sizes"])
    return run


def _joined(column, dtype):
    return np.frombuffer(b"".join(x.as_py() for x in column), dtype)


def _gather(order):
    """(token, cid, n, h1, h2) of the tokens of a bucket that several classes
    share; h1 and h2 name the set of these classes."""
    def run(table: pa.Table) -> pa.Table:
        tok, count = _joined(table["tokens"], np.uint64), _joined(table["counts"], np.int32)
        cid = np.repeat(_joined(table["cids"], np.int64), count)
        size = np.repeat(_joined(table["sizes"], np.int32), count).astype(np.int64)
        by = np.argsort(tok, kind="stable")
        tok, cid, size = tok[by], cid[by], size[by]
        start = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
        many = np.minimum.reduceat(cid, start) != np.maximum.reduceat(cid, start)
        # a salted shingle may have its other classes in other buckets
        many |= order.value[(tok[start] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= SALT_CLASS
        keep = np.repeat(many, np.diff(np.append(start, len(tok))))
        tok, cid, size = tok[keep], cid[keep], size[keep]
        by = np.lexsort((cid, tok))
        tok, cid, size = tok[by], cid[by], size[by]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (cid[1:] != cid[:-1])
        tok, cid, size = tok[new], cid[new], size[new]
        start = np.flatnonzero(np.append(True, tok[1:] != tok[:-1])[:len(tok)])
        length = np.diff(np.append(start, len(tok)))
        h = np.zeros((2, len(start)), np.uint64)
        if len(start):
            with np.errstate(over="ignore"):
                for k, salt in enumerate((_K1, _K2)):
                    h[k] = np.add.reduceat(tb.mix(cid.astype(np.uint64) ^ salt), start)
            # a salted shingle is here in part only: it stands for itself
            hot = order.value[(tok[start] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= SALT_CLASS
            h[0][hot], h[1][hot] = tok[start][hot], 0
        _, first = np.unique(h, axis=1, return_index=True)
        keep = np.zeros(len(start), bool)
        keep[first] = True
        keep = np.repeat(keep, length)
        h = np.repeat(h, length, axis=1)[:, keep].astype(np.int64)
        return pa.table({"token": tok[keep].astype(np.int64), "cid": cid[keep], "n": size[keep],
                         "h1": h[0], "h2": h[1]})
    return run


def prefix_entries(docs: DataFrame, order, n_buckets: int, chosen: DataFrame, kinds: DataFrame,
                   threshold=THRESHOLD, id_bits: int = 64, clashes: frozenset = frozenset()) -> DataFrame:
    """Prefix shingles of one text of each class.  A fixed-size Bloom filter
    holds the texts of classes with several rows: texts outside it are alone
    in their class and stay where they are, the others are joined with the
    ``chosen`` texts."""
    bloom = _bloom(kinds.join(chosen.where("m > 1").select("cid"), "cid"))
    texts = docs.select("text", "th2", "th1", F.coalesce("doc_id", F.lit(-1)).alias("d"))
    # rows that repeat id and text go before the join
    rest = texts.mapInArrow(_in_bloom(bloom, True), texts.schema).dropDuplicates(["d", "th1", "th2"])
    rest = rest.join(chosen.select("d", "th1", "th2").hint("merge"), ["d", "th1", "th2"])
    run, outside = _prefixes(order, n_buckets, threshold, id_bits, clashes), _in_bloom(bloom, False)

    def alone(batches):                  # one Python worker filters and shingles
        return run(outside(batches))

    return texts.mapInArrow(alone, _BLOB_DDL).union(rest.select("text").mapInArrow(run, _BLOB_DDL))


def buckets(texts: DataFrame, sets: DataFrame, threshold=THRESHOLD, id_bits: int = 64,
            clashes: frozenset = frozenset()) -> DataFrame:
    """(token, cid, n): classes that share a prefix shingle with others.  Of
    buckets with the same classes (the shingles of one shared passage) one is
    kept."""
    spark = texts.sparkSession
    order = spark.sparkContext.broadcast(shingle_order(sets))
    p, q = threshold
    kinds = materialize(sets.where("n > 0").groupBy("cid", "n", "th1", "th2").agg(
        F.min(F.coalesce("doc_id", F.lit(-1))).alias("d"), F.count("*").alias("m")), "kinds")
    chosen = materialize(kinds.groupBy("cid", "n").agg(
        F.min(F.struct("d", "th1", "th2")).alias("r"), F.sum("m").alias("m"))
        .select("cid", "n", "r.d", "r.th1", "r.th2", "m"), "classes")
    entries = chosen.agg(F.sum(F.col("n") - F.ceil(F.col("n") * p / q) + 1)).first()[0] or 0
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions")) // 4
    n_buckets = max(1, at_least, -(-int(entries) // BUCKET_ENTRIES))
    rows = materialize(
        prefix_entries(texts, order, n_buckets, chosen, kinds, threshold, id_bits, clashes)
        .groupBy("bucket").applyInArrow(_gather(order), "token long, cid long, n long, h1 long, h2 long"),
        "shared")
    discard(kinds)
    discard(chosen)
    one = rows.groupBy("h1", "h2").agg(F.min("token").alias("token"))
    out = materialize(rows.join(one, ["h1", "h2", "token"]).select("token", "cid", "n"), "buckets")
    discard(rows)
    return out


# ------------------------------------------------------------- verification

def jaccard_links(a: list, b: list, words: int = WORDS, threshold=THRESHOLD) -> list[bool]:
    """Whether the texts a[i] and b[i] link, by their shingles themselves."""
    data, off = tb.text_buffer(pa.array(a + b, pa.large_string()))
    w = tb.split_words(data, off, tb.NONSPACE)
    code = w.array().dictionary_encode().indices.to_numpy(zero_copy_only=False).tolist()
    first = w.first.tolist()
    known: dict = {}

    def shingles(i):
        at = (first[i], first[i + 1])
        x = code[at[0]:at[1]]
        if len(x) < words:
            return {tuple(x)} if x else set()
        return set(zip(*(x[k:] for k in range(words))))

    out, (p, q) = [], threshold
    for i in range(len(a)):
        if a[i] not in known:
            known[a[i]] = shingles(i)
        x, y = known[a[i]], shingles(len(a) + i)
        both = len(x & y)
        out.append(both > 0 and q * both >= p * (len(x) + len(y) - both))
        if len(known) > 256:
            known.clear()
    return out


def _verify(words, threshold):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ok = jaccard_links(part.column(2).to_pylist(), part.column(3).to_pylist(), words, threshold)
                yield pa.RecordBatch.from_arrays(part.filter(pa.array(ok)).columns[:2], names=["a", "b"])
    return run


BLOOM_WORDS = 20              # 2**20 words of 64 bits: 8 MB, whatever the corpus


def _bloom(texts: DataFrame):
    """Broadcast Bloom filter of the text hashes th2."""
    words = (texts.select(F.shiftrightunsigned("th2", 64 - BLOOM_WORDS).alias("w"),
                          F.expr("shiftleft(1L, cast(th2 & 63 as int))").alias("bit"))
             .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow())
    bloom = np.zeros(1 << BLOOM_WORDS, np.int64)
    bloom[words["w"].to_numpy()] = words["bits"].to_numpy()
    return texts.sparkSession.sparkContext.broadcast(bloom)


def _in_bloom(bloom, hit: bool):
    """Rows whose th2 is (or is not) in the filter."""
    def some(batches):
        for b in batches:
            h = b.column(b.schema.get_field_index("th2")).to_numpy()
            word = bloom.value[(h.astype(np.uint64) >> np.uint64(64 - BLOOM_WORDS)).astype(np.int64)]
            yield b.filter(pa.array(((word >> (h & 63)) & 1 == 1) == hit))
    return some


def _texts_of(cids: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, text): the text of one document of each class in ``cids``.  A
    fixed-size Bloom filter of text hashes keeps most other texts out of the
    shuffle; the join decides."""
    chosen = materialize(
        sets.where("n > 0").join(cids, "cid").groupBy("cid").agg(
            F.min(F.struct(F.coalesce("doc_id", F.lit(-1)).alias("d"), "th1", "th2")).alias("r"))
        .select("cid", "r.d", "r.th1", "r.th2"), "chosen")
    bloom = _bloom(chosen)
    kept = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("d"), "text", "th1", "th2")
    kept = kept.mapInArrow(_in_bloom(bloom, True), kept.schema)
    out = materialize(kept.join(chosen.hint("merge"), ["d", "th1", "th2"]).select("cid", "text")
                      .dropDuplicates(["cid"]), "texts")
    discard(chosen)
    return out


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words=WORDS,
             threshold=THRESHOLD, screened: bool = False) -> DataFrame:
    """The ``pairs`` (a, b) of classes that link.  ``screened``: their bitmaps
    have been compared already."""
    pairs = materialize(pairs, "candidates")
    if not screened:
        pairs, all_pairs = _possible(pairs, sets, threshold), pairs
        discard(all_pairs)
    cids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    t = _texts_of(cids, sets, docs)
    # texts grow with the input: the same joins at every size
    both = (pairs.join(t.select(F.col("cid").alias("a"), F.col("text").alias("ta")).hint("merge"), "a")
            .join(t.select(F.col("cid").alias("b"), F.col("text").alias("tb")).hint("merge"), "b")
            .select("a", "b", "ta", "tb"))
    links = materialize(both.mapInArrow(_verify(words, threshold), "a long, b long"), "links")
    discard(t)                           # the texts have been compared
    discard(pairs)
    return links


def _possible(pairs: DataFrame, sets: DataFrame, threshold) -> DataFrame:
    """Pairs whose bitmaps leave the threshold within reach (written once)."""
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    bits = _bits(ends, sets)

    def run(batches):
        for b in batches:
            na, nb = b.column(2).to_numpy(), b.column(4).to_numpy()
            wa, wb = b.column(3).to_pylist(), b.column(5).to_pylist()
            keep = np.zeros(b.num_rows, bool)
            need = min_overlap(na, nb, threshold)
            for i in np.flatnonzero(need <= np.minimum(na, nb)):
                x, y = _fold(wa[i], wb[i])
                shared = int(np.bitwise_count(x & y).sum())
                slack = min(na[i] - int(np.bitwise_count(x).sum()), nb[i] - int(np.bitwise_count(y).sum()))
                keep[i] = shared + slack >= need[i]
            yield pa.RecordBatch.from_arrays(b.filter(pa.array(keep)).columns[:2], names=["a", "b"])

    both = (pairs.join(bits.toDF("a", "na", "wa"), "a").join(bits.toDF("b", "nb", "wb"), "b")
            .select("a", "b", "na", "wa", "nb", "wb"))
    return materialize(both.mapInArrow(run, "a long, b long"), "pairs")


def _bits(cids: DataFrame, sets: DataFrame) -> DataFrame:
    return (sets.where("n > 0").select("cid", "n", "bits").join(cids, "cid")
            .dropDuplicates(["cid"]).select("cid", "n", "bits"))


def _fold(x: bytes, y: bytes):
    """Both bitmaps as 64-bit words, folded to the shorter one's width."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    w = min(len(x), len(y))
    return _fold_one(x, w), _fold_one(y, w)


def _fold_one(x: np.ndarray, words: int) -> np.ndarray:
    """The bitmap under a hash of fewer bits."""
    while len(x) > words:
        x = x[:len(x) // 2] | x[len(x) // 2:]
    return x


# --------------------------------------------------------------- star round

def star_pairs(bucket: DataFrame, seed: int, threshold=THRESHOLD) -> DataFrame:
    """(a, b): every class of a bucket with its centres.  Within a band of
    set sizes (a factor of 1.25) the centre is the class of smallest hash, one
    per component of the bucket that is not the centre's; centres of
    neighbouring bands are paired too.  ``bucket``: as ``_with_comp`` returns."""
    pick = F.struct(F.xxhash64(F.lit(seed), "cid").alias("h"), "cid", "n", "comp")
    centre = bucket.groupBy("token", "band").agg(F.min(pick).alias("x")).select(
        "token", "band", F.col("x.cid").alias("a"), F.col("x.n").alias("na"), F.col("x.comp").alias("ca"))
    # each class with its band's centre, each centre with the next band's
    below = centre.select("token", (F.col("band") + 1).alias("band"), F.col("a").alias("cid"),
                          F.col("na").alias("n"), F.col("ca").alias("comp"))
    one = bucket.select("token", "band", "cid", "n", "comp").unionByName(below)
    pairs = one.join(centre, ["token", "band"]).where(
        (F.col("comp") != F.col("ca")) & (F.col("a") != F.col("cid"))
        & (F.least("n", "na") * threshold[1] >= F.greatest("n", "na") * threshold[0]))
    return pairs.select(F.least("a", "cid").alias("a"), F.greatest("a", "cid").alias("b")).distinct()


# ----------------------------------------------------------- signature tree

class Tree:
    """Signature tree over classes sorted by size: level 0 holds the classes,
    a node of the next level covers ``FANOUT`` nodes below."""

    def __init__(self, cid, size, comp, bits, width):
        order = np.lexsort((cid, size))
        self.cid = cid[order]
        rows = np.stack([_fold_one(bits[i], width) for i in order])
        # tokens beyond one per set bit: how far a bitmap can under-count
        slack = size[order] - np.bitwise_count(rows).sum(1).astype(np.int64)
        self.levels = [(rows, size[order], size[order], slack, comp[order])]
        while len(self.levels[-1][0]) > 1:
            rows, low, high, slack, comp = self.levels[-1]
            at = np.arange(0, len(rows), FANOUT)
            least, most = np.minimum.reduceat(comp, at), np.maximum.reduceat(comp, at)
            self.levels.append((np.bitwise_or.reduceat(rows, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at),
                                np.where(least == most, least, -1)))


NO_COMP = -1                  # a node over several components


def dual_traversal(x: Tree, y: Tree, threshold=THRESHOLD):
    """Index pairs (i of x, j of y) of classes that the bounds cannot rule
    out.  With ``x is y`` each unordered pair comes once."""
    same = x is y
    depth = max(len(x.levels), len(y.levels)) - 1
    i = j = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        lx, ly = x.levels[min(level, len(x.levels) - 1)], y.levels[min(level, len(y.levels) - 1)]
        if level < depth:
            i, j = _children(i, j, len(x.levels) > level + 1, len(y.levels) > level + 1,
                             len(lx[0]), len(ly[0]))
            if same:
                on = i <= j if level else i < j
                i, j = i[on], j[on]
        elif same and level == 0:
            return i[:0], j[:0]
        keep = np.zeros(len(i), bool)
        step = max(1, min(4096, TREE_BYTES // lx[0][0].nbytes))
        for lo in range(0, len(i), step):
            a, b = i[lo:lo + step], j[lo:lo + step]
            need = min_overlap(lx[1][a], ly[1][b], threshold)
            # the sizes nearest to each other decide the best possible ratio
            need = np.maximum(need, -(-threshold[0] * np.maximum(lx[1][a], ly[1][b]) // threshold[1]))
            ok = np.minimum(lx[2][a], ly[2][b]) >= need
            ca, cb = lx[4][a], ly[4][b]
            ok &= (ca != cb) | (ca == NO_COMP)
            at = np.flatnonzero(ok)
            shared = np.bitwise_count(lx[0][a[at]] & ly[0][b[at]]).sum(1).astype(np.int64)
            ok[at] = shared + np.minimum(lx[3][a[at]], ly[3][b[at]]) >= need[at]
            keep[lo:lo + step] = ok
        i, j = i[keep], j[keep]
        if not len(i):
            break
    return i, j


def _children(i, j, split_i, split_j, ni, nj):
    def down(v, split, n):
        return (v[:, None] * FANOUT + np.arange(FANOUT)) if split else v[:, None]

    a, b = down(i, split_i, ni), down(j, split_j, nj)
    ca, cb = a.shape[1], b.shape[1]
    a = np.repeat(a, cb, axis=1).ravel()
    b = np.tile(b, (1, ca)).ravel()
    on = (a < ni) & (b < nj)
    return a[on], b[on]


def _first_shared(token: int, x: np.ndarray, y: np.ndarray) -> bool:
    """Whether ``token`` is the smallest that two sorted arrays share."""
    x, y = x[:np.searchsorted(x, token)], y[:np.searchsorted(y, token)]
    return not np.isin(x, y, assume_unique=True).any()


def _trees(threshold):
    """Traverse the trees of each (token, low, high) run of sorted rows.  A pair
    that shares several buckets comes from that of its smallest token only."""
    def one(cols, lo, hi):
        """Linked sets differ by at most 1.25 in size, so by at most 2 in
        bitmap width: trees of equal width meet, and each meets the next."""
        cid, size, side, comp = (c[lo:hi] for c in cols[:4])
        bits = [np.frombuffer(x, np.uint64) for x in cols[4][lo:hi]]
        width = np.array([len(x) for x in bits])
        two = bool(cols[5][lo])
        token = cols[6][lo]
        flat, off = cols[7], cols[8]
        own = {c: flat[off[k]:off[k + 1]] for k, c in enumerate(cid.tolist(), lo)}

        def tree(s, w, folded):
            at = np.flatnonzero((side == s) & (width == w))
            return Tree(cid[at], size[at], comp[at], [bits[k] for k in at], folded) if len(at) else None

        for w in np.unique(width):
            x = tree(0, w, w)
            meets = [(x, tree(1, w, w)), (x, tree(1, 2 * w, w)), (tree(0, 2 * w, w), tree(1, w, w))] \
                if two else [(x, x), (x, tree(0, 2 * w, w))]
            for x, y in meets:
                if x is not None and y is not None:
                    i, j = dual_traversal(x, y, threshold)
                    a, b = x.cid[i], y.cid[j]
                    on = [_first_shared(token, own[u], own[v]) for u, v in zip(a.tolist(), b.tolist())]
                    if any(on):
                        yield a[on], b[on]

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            cut = borders(held)
            if not len(cut):
                continue
            yield from emit(held.slice(0, int(cut[-1])))
            held = held.slice(int(cut[-1]))
        if held is not None and held.num_rows:
            yield from emit(held)

    def borders(t):
        new = np.zeros(max(t.num_rows - 1, 0), bool)
        for c in ("token", "low", "high"):
            x = t[c].combine_chunks().to_numpy()
            new |= x[1:] != x[:-1]
        return np.flatnonzero(new) + 1

    def emit(t):
        cut = np.concatenate([[0], borders(t), [t.num_rows]])
        cols = [t[c].combine_chunks().to_numpy() for c in ("cid", "n", "side", "comp")]
        cols += [t["bits"].to_pylist(), t["two"].combine_chunks().to_numpy(zero_copy_only=False)]
        tokens = t["tokens"].combine_chunks()
        cols += [t["token"].combine_chunks().to_numpy(), tokens.values.to_numpy(), tokens.offsets.to_numpy()]
        a, b = [], []
        for lo, hi in zip(cut[:-1], cut[1:]):
            if hi - lo > 1:
                for x, y in one(cols, lo, hi):
                    a.append(np.minimum(x, y))
                    b.append(np.maximum(x, y))
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return run


def tree_pairs(bucket: DataFrame, sets: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """(a, b): pairs of different components that the signature trees of the
    buckets leave over.  ``bucket``: token, cid, n, comp (no bucket within
    one component)."""
    per = bucket.groupBy("token").agg(F.ceil(F.count("*") / F.lit(TREE_BLOCK)).alias("blocks"))
    rows = bucket.join(per, "token").withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    # block k meets every block m: as side 0 of (k, m) for k <= m, else side 1
    rows = rows.withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "token", "cid", "n", "comp", (F.col("block") > F.col("m")).cast("int").alias("side"),
        (F.col("block") != F.col("m")).alias("two"),
        F.least("block", "m").alias("low"), F.greatest("block", "m").alias("high"))
    bits = _bits(bucket.select("cid").distinct(), sets).select("cid", "bits")
    # the tokens of a class are at most its own prefix
    own = bucket.groupBy("cid").agg(F.sort_array(F.collect_set("token")).alias("tokens"))
    bits = bits.join(own, "cid")
    run = ("token", "low", "high")
    rows = rows.join(bits, "cid").repartition(*run).sortWithinPartitions(*run)
    return rows.select(*run, "cid", "n", "comp", "side", "two", "bits", "tokens").mapInArrow(
        _trees(threshold), "a long, b long").distinct()


# -------------------------------------------------------------------- joins

def _band(threshold) -> Column:
    """Sets that link differ by a factor of q / p in size at most, so by one
    band."""
    p, q = threshold
    return F.floor(F.log(F.col("n").cast("double")) / math.log(q / p)).alias("band")


def _with_comp(bucket: DataFrame, comps: DataFrame | None, threshold=THRESHOLD) -> DataFrame:
    """(token, cid, n, comp, band): the rows of buckets that meet another
    component among the sizes near their own."""
    if comps is None:
        b = bucket.select("token", "cid", "n", F.col("cid").alias("comp"), _band(threshold))
    else:
        b = (bucket.join(comps.withColumnRenamed("node", "cid"), "cid", "left")
             .select("token", "cid", "n", F.coalesce("comp", "cid").alias("comp"), _band(threshold)))
    # bands k - 1, k and k + 1 matter to band k
    per = b.groupBy("token", "band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    per = per.select("token", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("band"), "x", "y")
    mixed = per.groupBy("token", "band").agg(F.min("x").alias("x"), F.max("y").alias("y")).where("x <> y")
    return b.join(mixed.select("token", "band"), ["token", "band"])


def _classes(documents: DataFrame, doc_id: str, text: str, threshold, id_bits: int):
    """(texts, rows of the set table, buckets).

    Two sets may share their first 64 bits; about n * n / 2**65 do (24 among
    3 * 10**10 sets), so their ids are held by the driver.  Such classes are
    named by their other 64 bits."""
    arrow_session(documents)
    docs = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("th1"), F.xxhash64(F.lit(1), F.col(text)).alias("th2"))
    sets = materialize(docs.mapInArrow(lambda batches: _sets(batches, id_bits), _SET_DDL), "sets")
    both = sets.where("n > 0").groupBy("cid").agg(F.min("check").alias("x"), F.max("check").alias("y"))
    clashes = frozenset(r["cid"] for r in both.where("x <> y").select("cid").collect())
    if clashes:
        sets = sets.withColumn("cid", F.when(F.col("cid").isin(*clashes), F.col("check"))
                               .otherwise(F.col("cid")))
    return docs, sets.where("slice is null"), buckets(docs, sets, threshold, id_bits, clashes)


def components(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               threshold=THRESHOLD, id_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    docs, rows, bucket = _classes(documents, doc_id, text, threshold, id_bits)
    links, comps = None, None
    left = materialize(_with_comp(bucket, comps, threshold), "mixed")
    n_left = left.count()
    for k in range(STAR_ROUNDS):
        found = verified(star_pairs(left, k, threshold), rows, docs, threshold=threshold)
        if found.isEmpty():
            break
        discard(left)
        links = found if links is None else links.union(found)
        comps = materialize(connected_components(links), "comps")
        left = materialize(_with_comp(bucket, comps, threshold), "mixed")
        before, n_left = n_left, left.count()
        if n_left > (1 - SETTLED) * before:
            break
    found = verified(tree_pairs(left, rows, threshold), rows, docs, threshold=threshold, screened=True)
    if not found.isEmpty():
        comps = connected_components(found if links is None else links.union(found))
    discard(left)
    discard(bucket)
    classes = rows.groupBy("cid").agg(F.min("doc_id").alias("least")).where("cid is not null")
    if comps is not None:
        classes = classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left")
        classes = classes.withColumn("comp", F.coalesce("comp", "cid"))
        names = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
        classes = classes.join(names, "comp")
    else:
        classes = classes.withColumnRenamed("least", "component_id")
    # rows without shingles have no class; their keys only spread them
    key = F.coalesce("cid", F.xxhash64("doc_id")).alias("cid")
    return (rows.select("doc_id", "n", key)
            .join(classes.select("cid", "component_id"), "cid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def link_counts(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                threshold=THRESHOLD, id_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, class_id, n_links) of every row: the class of equal
    sets (null without shingles) and the number of other rows that it links
    with, those of its own class included.  The signature trees run over all
    buckets, without star rounds: every linked pair of classes is found and
    verified, also within a component; copies are counted, not paired."""
    docs, rows, bucket = _classes(documents, doc_id, text, threshold, id_bits)
    pairs = tree_pairs(bucket.withColumn("comp", F.col("cid")), rows, threshold)
    links = verified(pairs, rows, docs, threshold=threshold, screened=True)
    discard(bucket)
    size = materialize(rows.where("n > 0").groupBy("cid").agg(F.count("*").alias("size")), "sizes")
    both = links.select("a", "b").union(links.select("b", "a"))
    far = (both.join(size.withColumnRenamed("cid", "b"), "b")
           .groupBy("a").agg(F.sum("size").alias("far")).withColumnRenamed("a", "cid"))
    per = size.join(far, "cid", "left").select(
        "cid", (F.col("size") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    key = F.coalesce("cid", F.xxhash64("doc_id")).alias("cid")
    return (rows.select("doc_id", "n", F.col("cid").alias("class_id"), key).join(per, "cid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), "class_id",
                    F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links")))


def keep_one(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component (its smallest id), columns unchanged.
    Rows that repeat an id stay or go together; rows without id stay."""
    c = components(documents.select(doc_id, text), doc_id=doc_id, text=text)
    drop = c.where("doc_id <> component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return documents.join(drop, doc_id, "left_anti").select(*documents.columns)
