"""Operator 12, collocations counted in counting quotient filters.

``bundle`` cuts the texts into words inside each task and keeps them as
arrays of word numbers, some megabytes of text a bundle.  Words that are
frequent enough get dense ids (a join on the words of each bundle; no list
of words is broadcast by hand).  Then two rounds count phrases: pairs of
word ids, and, over the ids of frequent pairs, phrases of three words (two
pairs that share a word) and of four (two pairs whose words follow each
other).  A phrase with ``least`` occurrences has only parts with as many, so
nothing is lost.

A packed pair of ids is permuted invertibly (a Feistel network over its two
halves), its high bits are the quotient and the rest the full remainder:
no two phrases share a counter.  The quotient's first bits name the shard;
in a shard, the other quotient bits are a bit vector (runs in unary), the
remainders are packed to whole bytes and the counts to one byte, larger ones
aside (``encode``, ``decode``).  The sorted filters of a shard from all
bundles are merged, the frequent counters decoded and inverted back, and each
bundle told which of its pairs are among them.

Scale: a task holds one bundle, or the filters of one shard (about
``SHARD`` occurrences, as many shards as the corpus needs); one phrase that
is everywhere is one counter of each bundle.  Joins and the rest are Spark's.
Ids have 31 bits at most: beyond 2^31 frequent words, or pairs, it raises.

Defined results: a null text is read as an empty one, a null language as
``und``; rows count as often as they occur; texts without words, and empty
tables, give nothing; other columns are not read; the longest texts are read
whole (a text longer than a bundle is a bundle).  Ties of the ranking go to
the least phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import arrow_session, materialize

LEAST = 30                    # occurrences of a candidate
TOP = 2000                    # candidates reported per language (the report's size)
SCALE = 2_000_000             # of the score
BUNDLE_BYTES = 6 << 20        # text of a bundle, about
SHARD = 1 << 19               # occurrences per shard, about
IDS_PER_BUCKET = 100_000      # ids dealt out by one task, about
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t",
                        b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")


# ---- bundles of numbered words -----------------------------------------------

def _numbered(texts: list[str | None], offset: int) -> tuple[pa.Array, np.ndarray]:
    """The different words of the texts, and all words as their numbers from
    ``offset`` on, with -1 between pieces."""
    data = b"\n".join((t or "").encode() for t in texts).translate(_FOLD).replace(b"\n", b" \n ")
    # one string of the batch at most: its words are counted in 32 bits
    words = pc.list_flatten(pc.split_pattern(pa.array([data.decode()], pa.large_string()), " "))
    coded = words.dictionary_encode()
    numbers, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    number_of = np.full(len(names), -2, np.int32)
    real = np.array([n not in ("", "\n") for n in names.to_pylist()], bool)
    number_of[real] = offset + np.arange(int(real.sum()))
    at = pc.index(names, pa.scalar("\n", names.type)).as_py()
    if at >= 0:
        number_of[at] = -1
    out = number_of[numbers]
    return names.filter(pa.array(real)).cast(pa.string()), out[out != -2].astype(np.int32)


BUNDLES = pa.schema([("bundle", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())),
                     ("counts", pa.list_(pa.int64())), ("at", pa.binary())])
_BUNDLES_DDL = "bundle long, langs array<string>, words array<string>, counts array<long>, at binary"


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 32, 0
    held: dict[str, list] = {}
    size = 0

    def out() -> pa.RecordBatch:
        nonlocal made, size, held
        langs, words, at, offset = [], [], [], 0
        for lang, texts in held.items():
            names, numbers = _numbered(texts, offset)
            offset += len(names)
            langs.append(pa.repeat(pa.scalar(lang, pa.string()), len(names)))
            words.append(names)
            at += [numbers, np.array([-1], np.int32)]
        at = np.concatenate(at) if at else np.zeros(0, np.int32)
        counts = np.bincount(at[at >= 0], minlength=offset)
        made, size, held = made + 1, 0, {}
        ends = pa.array([0, offset], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, x) for x in (
            pa.concat_arrays(langs), pa.concat_arrays(words), pa.array(counts.astype(np.int64)))]
        return pa.RecordBatch.from_arrays([pa.array([base + made - 1]), *lists, pa.array([at.tobytes()], pa.binary())],
                                          schema=BUNDLES)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                held.setdefault(lang, []).append(text)
                size += len(text)
        if size >= BUNDLE_BYTES:
            yield out()
    if size:
        yield out()


def bundle(documents: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(bundle, langs, words, counts, at): words with their languages and
    counts, and the texts as positions in these lists (int32, -1 between
    pieces)."""
    arrow_session(documents)
    rows = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                            F.col(text).alias("text"))
    return materialize(rows.mapInArrow(_bundle, _BUNDLES_DDL), "bundles")


def with_ids(df: DataFrame, *key: str) -> DataFrame:
    """``df`` with a dense-enough ``id`` from 1 on for each of its rows, which
    differ in ``key``: dealt out in buckets by hash, row by row within each."""
    buckets = max(1, math.ceil(df.count() / IDS_PER_BUCKET))
    rows = df.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy("_b").orderBy(*key))
    out = materialize(rows.withColumn("id", (place.cast("long") - 1) * buckets + F.col("_b") + 1).drop("_b"), "ids")
    return out


def _bits(ids: DataFrame, least: int) -> int:
    """Bits of the largest ``id``, ``least`` or more."""
    bits = max(least, int(ids.agg(F.max("id")).first()[0] or 1).bit_length())
    if bits > 31:
        raise ValueError(f"ids of {bits} bits; a packed pair holds 31 bits each")
    return bits


# ---- counting quotient filters -------------------------------------------------

_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _mix(x: np.ndarray, constant: int, bits: int) -> np.ndarray:
    x = (x + np.uint64(constant & 0xFFFFFFFF)) * np.uint64(constant)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)) & np.uint64((1 << bits) - 1)


def permute(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Pairs of ids of ``bits`` bits, 31 at most, as permuted keys of twice as
    many bits."""
    for constant in _ROUNDS:
        a, b = b, a ^ _mix(b, constant, bits)
    return (a << np.uint64(bits)) | b


def invert(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = keys >> np.uint64(bits), keys & np.uint64((1 << bits) - 1)
    for constant in reversed(_ROUNDS):
        a, b = b ^ _mix(a, constant, bits), a
    return a, b


def encode(keys: np.ndarray, counts: np.ndarray, bits: int) -> tuple[int, bytes, bytes, bytes, bytes]:
    """A filter of sorted, different keys below 2^bits: quotient bits, runs in
    unary, remainders, counts of a byte, larger counts."""
    n = len(keys)
    q = min(max(n.bit_length() - 1, 0), bits)
    r = bits - q
    quotient = (keys >> np.uint64(r)).astype(np.int64)
    unary = np.zeros(n + (1 << q), np.uint8)
    unary[quotient + np.arange(n)] = 1
    rest = keys & np.uint64((1 << r) - 1)
    packed = rest.astype("<u8").view(np.uint8).reshape(n, 8)[:, :-(-r // 8)]
    large = counts >= 255
    return (q, np.packbits(unary).tobytes(), np.ascontiguousarray(packed).tobytes(),
            np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes())


def decode(q: int, unary: bytes, rest: bytes, small: bytes, large: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of a filter."""
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    n, r = len(counts), bits - q
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8))[:n + (1 << q)])
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :-(-r // 8)] = np.frombuffer(rest, np.uint8).reshape(n, -(-r // 8))
    keys = ((ones - np.arange(n)).astype(np.uint64) << np.uint64(r)) | wide.view("<u8").ravel()
    counts[counts == 255] = np.frombuffer(large, "<i8")
    return keys, counts


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted filter of several sorted ones; counts of a key add up."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")      # merges the sorted runs
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


_FILTER = pa.schema([("n", pa.int32()), ("shard", pa.int64()), ("q", pa.int32()), ("unary", pa.binary()),
                     ("rest", pa.binary()), ("small", pa.binary()), ("large", pa.binary()),
                     ("bundle", pa.int64()), ("at", pa.binary())])
_FILTER_DDL = "n int, shard long, q int, unary binary, rest binary, small binary, large binary, bundle long, at binary"


def _filters(n: int, bundle: int, a: np.ndarray, b: np.ndarray, bits: int, shard_bits: int) -> pa.RecordBatch:
    """The filters of one bundle, one per shard."""
    keys, counts = np.unique(permute(a.astype(np.uint64), b.astype(np.uint64), bits), return_counts=True)
    low = 2 * bits - shard_bits
    shard = (keys >> np.uint64(low)).astype(np.int64) if shard_bits else np.zeros(len(keys), np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(keys)]]) if len(keys) else [0]
    rows = [(int(shard[x]), encode(keys[x:y] & np.uint64((1 << low) - 1), counts[x:y], low))
            for x, y in zip(cuts[:-1], cuts[1:])]
    parts = list(zip(*(r[1] for r in rows))) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array([n] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()), pa.array(parts[0], pa.int32()),
         *(pa.array(p, pa.binary()) for p in parts[1:]), pa.array([bundle] * len(rows), pa.int64()),
         pa.nulls(len(rows), pa.binary())], schema=_FILTER)


def _of_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 31) | b.astype(np.int64)


def _pairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair of word ids starts, and the pairs there as one number."""
    at = np.flatnonzero((a[:-1] > 0) & (a[1:] > 0))
    return at, _of_pair(a[at], a[at + 1])


def _whole(t: pa.Table, column: str, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b"".join(t.column(column).to_pylist()), kind)


_FREQUENT = pa.schema([("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("f", pa.int64()), ("id", pa.int64()),
                       ("bundle", pa.int64()), ("key", pa.binary()), ("ids", pa.binary())])
_FREQUENT_DDL = "n int, a long, b long, f long, id long, bundle long, key binary, ids binary"


def frequent(filters: DataFrame, bits: int, shard_bits: int, least: int, back: bool = False) -> DataFrame:
    """(n, a, b, f, id): the merged counters of ``least`` or more, inverted,
    each with an id from 1 on (its place in the shard times the number of
    shards, plus the shard).  With ``back``, also a row per bundle and shard
    that tells the bundle which of its pairs are frequent, and their ids."""
    low, shards = 2 * bits - shard_bits, 1 << shard_bits

    def one(t: pa.Table) -> pa.Table:
        n, shard = t.column("n")[0].as_py(), t.column("shard")[0].as_py()
        parts = [decode(*row, low) for row in zip(*(t.column(c).to_pylist() for c in ("q", "unary", "rest", "small", "large")))]
        keys, counts = merge(parts)
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
        a, b = (x.astype(np.int64) for x in invert(keys | np.uint64(shard << low), bits))
        ids = np.arange(len(keys), dtype=np.int64) * shards + shard + 1
        size = len(keys)
        out = [pa.Table.from_arrays([pa.array(np.full(size, n, np.int32)), pa.array(a), pa.array(b), pa.array(counts), pa.array(ids),
                                     pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary())],
                                    schema=_FREQUENT)]
        if back and size:
            pair, told = _of_pair(a, b), []
            for bundle, (own, _) in zip(t.column("bundle").to_pylist(), parts):
                at = np.minimum(np.searchsorted(keys, own), size - 1)
                at = at[keys[at] == own]
                told.append({"n": n, "bundle": bundle, "key": pair[at].tobytes(), "ids": ids[at].tobytes()})
            out.append(pa.Table.from_pylist(told, schema=_FREQUENT))
        return pa.concat_tables(out)

    rows = filters.where("shard is not null").select("n", "shard", "bundle", "q", "unary", "rest", "small", "large")
    return materialize(rows.groupBy("n", "shard").applyInArrow(one, _FREQUENT_DDL), "frequent")


def _each_bundle(bundles: DataFrame, known: DataFrame, run) -> DataFrame:
    """``run`` on each bundle (bundle, at) together with its own part of the
    ids (bundle, key, id)."""
    def one(at: pa.Table, ids: pa.Table) -> pa.Table:
        if not at.num_rows:
            return _FILTER.empty_table()
        return pa.Table.from_batches(list(run(at.column("bundle")[0].as_py(), at.column("at")[0].as_py(), ids)), schema=_FILTER)

    return bundles.select("bundle", "at").groupBy("bundle").cogroup(known.toDF("of", "key", "id").groupBy("of")).applyInArrow(one, _FILTER_DDL)


def count_phrases(bundles: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(totals, phrases): (lang, n) words of each language, and (lang, phrase,
    k, f) for all phrases of one to four words that occur ``least`` times."""
    spark = bundles.sparkSession
    held = bundles.select("bundle", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("key", "w"))
    words = held.groupBy(F.col("w.langs").alias("lang"), F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    words = materialize(words, "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    tokens = int(totals.agg(F.sum("n")).first()[0] or 0)
    shard_bits = max(0, math.ceil(math.log2(max(tokens, 1) / SHARD)))
    vocabulary = with_ids(words.where(F.col("f") >= least), "lang", "word")
    bits = _bits(vocabulary, -(-shard_bits // 2) + 1)

    def first_round(bundle: int, at: bytes, ids: pa.Table) -> Iterator[pa.RecordBatch]:
        key, id_ = (np.asarray(ids.column(c)) for c in ("key", "id"))
        local = np.frombuffer(at, np.int32)
        to = np.zeros(max(int(local.max(initial=0)), int(key.max(initial=0))) + 2, np.int32)
        to[key + 1] = id_
        a = to[local + 1]                       # 0 between pieces and for rare words
        start, _ = _pairs(a)
        yield _filters(2, bundle, a[start], a[start + 1], bits, shard_bits)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, f.type) for f in _FILTER][:7] + [pa.array([bundle]), pa.array([a.tobytes()])], schema=_FILTER)

    word = vocabulary.select("lang", "word", "id")
    known = held.join(word, (F.col("w.langs") == F.col("lang")) & (F.col("w.words") == F.col("word"))).select("bundle", "key", "id")
    round1 = materialize(_each_bundle(bundles, known, first_round), "pairs")
    merged = frequent(round1, bits, shard_bits, least, back=True)
    pairs = merged.where("bundle is null").select("a", "b", "f", "id")
    pair_bits = _bits(pairs, -(-shard_bits // 2) + 1)
    coded = round1.where("at is not null").select("bundle", "at")

    def second_round(bundle: int, at: bytes, ids: pa.Table) -> Iterator[pa.RecordBatch]:
        key, id_ = _whole(ids, "key"), _whole(ids, "id")
        a = np.frombuffer(at, np.int32)
        order = np.argsort(key)
        key, id_ = key[order], id_[order]
        start, pair = _pairs(a)
        p = np.zeros(len(a) + 3, np.int64)      # ids of the frequent pairs, by place
        if len(key):
            spot = np.minimum(np.searchsorted(key, pair), len(key) - 1)
            p[start] = np.where(key[spot] == pair, id_[spot], 0)
        two = np.flatnonzero((p[:-1] > 0) & (p[1:] > 0))
        yield _filters(3, bundle, p[two], p[two + 1], pair_bits, shard_bits)
        three = two[p[two + 2] > 0]
        yield _filters(4, bundle, p[three], p[three + 2], pair_bits, shard_bits)

    known = merged.where("bundle is not null").select("bundle", "key", "ids")
    round2 = materialize(_each_bundle(coded, known, second_round), "longer")
    longer = frequent(round2, pair_bits, shard_bits, least)

    # back to words
    w = vocabulary.select("id", "lang", F.col("word"))
    named = (pairs.select("id", "a", "b", "f")
             .join(w.select(F.col("id").alias("a"), "lang", F.col("word").alias("w1")), "a")
             .join(w.select(F.col("id").alias("b"), F.col("word").alias("w2")), "b"))
    named = materialize(named.select("id", "lang", "w1", "w2", "f"), "named")
    x = named.select(F.col("id").alias("a"), "lang", "w1", "w2")
    y = named.select(F.col("id").alias("b"), F.col("w1").alias("w3"), F.col("w2").alias("w4"))
    more = longer.join(x, "a").join(y, "b").select("lang", F.when(
        F.col("n") == 3, F.concat_ws(" ", "w1", "w2", "w4")).otherwise(F.concat_ws(" ", "w1", "w2", "w3", "w4")).alias("phrase"),
        F.col("n").alias("k"), "f")
    phrases = (vocabulary.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "f")
               .unionByName(named.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.lit(2).alias("k"), "f"))
               .unionByName(more))
    return totals, materialize(phrases, "phrases")


# ---- scores ----------------------------------------------------------------------

def _words(phrase: str, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def collocations(documents: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language.  The arithmetic is in decimals of 38 digits."""
    totals, counts = count_phrases(bundle(documents, lang, text), least)
    found = counts.where("k > 1")
    part = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = (cuts.withColumn("left", _words("phrase", F.lit(1), F.col("cut")))
            .withColumn("right", _words("phrase", F.col("cut") + 1, F.col("k") - F.col("cut"))))
    cuts = (cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"])
            .join(part.toDF("lang", "right", "r"), ["lang", "right"]))
    wide = "decimal(38,0)"
    score = F.expr(f"cast(cast({SCALE} as {wide}) * cast(a as decimal(19,0)) div cast(l + r as {wide}) as long)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    # phrases inside longer ones that occur almost as often
    inner = found.where("k > 2").select("lang", "phrase", "f", F.col("k").alias("of"), F.explode(
        F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "f", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("of") - F.col("size") + 1), lambda i: _words("phrase", i, F.col("size")))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = F.col("longer").cast(wide) * 100 >= F.col("a").cast(wide) * 80
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)
    order = Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("m.l").alias("l"),
        F.col("m.r").alias("r"), F.col("n").cast("long").alias("n"), F.col("m.score").alias("score"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f
      FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
      GROUP BY lang, k, phrase HAVING count(*) >= {LEAST}),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
u AS (SELECT lang, phrase, k, w, f AS a, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT u.lang, u.phrase, u.a, cut, x.f AS l, y.f AS r,
             CAST((CAST({SCALE} AS HUGEINT) * a) // (x.f + y.f) AS BIGINT) AS score
      FROM u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(w[1:cut], ' ')
      JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, inner_phrase AS phrase, max(f) AS longer
      FROM (SELECT lang, f, unnest(list_transform(range(1, k - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS inner_phrase
            FROM (SELECT *, unnest(range(2, k)) AS size FROM c WHERE k > 2)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b LEFT JOIN i USING (lang, phrase) JOIN n USING (lang)
WHERE longer IS NULL OR CAST(longer AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
QUALIFY rank <= {TOP}"""
