"""Operator 3, benchmark decontamination by training suffix arrays.

The corpus is cut into shards (runs of whole documents of bounded bytes
inside Spark's partitions).  Each task builds the suffix array of its shard's
words and binary-searches every test suffix in it: the range of corpus
suffixes that start with the test window gives all verbatim locations, and
widening the match word by word gives the longest one.  Documents that hold a
window are then removed (``remove``) or reported (``scan``).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  They
are compared as whole byte strings (Arrow's dictionary), not as hashes.

Benchmark texts are sent to the tasks in blocks of a bounded number of words
(``block_words``); a benchmark of more blocks makes one more pass over the
corpus per block, and the passes' spans are merged.

Defined results: a null or wordless text has no words, no hit and no item; an
item without words matches nothing; an item with null ``item_id`` counts under
the id ``null``; repeated documents are each reported; repeated items count
once per id; an empty table on either side gives no hits.  Other columns of
the corpus ride along in one struct, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm import textbytes as tb
from forumlens.llm.common import arrow_session, row_struct, struct_field

WINDOW = 10                  # words of a benchmark window
SHARD_BYTES = 6 << 20        # text bytes of a shard (one longer document alone)
BLOCK_WORDS = 2_000_000      # benchmark words held by a task at once

RESULT = ("n_words long, longest long, spans array<struct<start:long,stop:long>>, "
          "items array<string>")


def suffix_array(ids: np.ndarray, n_ids: int) -> np.ndarray:
    """Order of all suffixes of ``ids`` (values 0..n_ids-1; an end sorts
    first), by prefix doubling: start with three symbols in one key, then
    re-sort only groups that still tie."""
    n = len(ids)
    if n == 0:
        return np.empty(0, np.int64)
    bits = max(1, int(n_ids).bit_length())
    pack = max(1, 63 // bits)
    pad = np.concatenate([ids.astype(np.int64) + 1, np.zeros(pack, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(pack):
        key = (key << bits) | pad[k:k + n]
    sa = np.argsort(key, kind="stable")
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[sa[1:]], key[sa[:-1]], out=new[1:])
    rank = np.empty(n + 1, np.int64)     # rank = first place of the suffix's group
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth = pack
    while True:
        tied = ~(new & np.append(new[1:], True))     # places in groups of several
        place = np.flatnonzero(tied)
        if len(place) == 0:
            return sa
        who = sa[place]
        group = rank[who]
        after = rank[np.minimum(who + depth, n)]
        order = np.lexsort((after, group))
        who, group, after = who[order], group[order], after[order]
        sa[place] = who
        fresh = np.empty(len(place), bool)
        fresh[0] = True
        fresh[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        new[place] = fresh
        rank[who] = np.maximum.accumulate(np.where(fresh, place, 0))
        depth *= 2


class TestSet:
    """Words of a block of benchmark items, with the needed match length of
    every suffix that starts a window."""

    def __init__(self, ids: list, texts: list, window: int):
        data, off = tb.text_buffer(pa.array(texts, pa.string()))
        w = tb.split_words(data, off, tb.ALNUM)
        enc = w.array().dictionary_encode()
        self.values = enc.dictionary
        self.ids = ["null" if i is None else str(i) for i in ids]
        code = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        count = np.diff(w.first)
        item = np.repeat(np.arange(len(count)), count)
        left = np.repeat(w.first[1:], count) - np.arange(len(code))
        need = np.minimum(window, np.repeat(count, count))
        at = np.flatnonzero(left >= need)
        self.code, self.left, self.need, self.item = code, left, need, item
        self.start = at


def search(sa, words, test_words, starts, left):
    """Longest match of every test suffix in the suffix array.

    The range [lo, hi) of suffixes that share the first d words narrows word
    by word, all test suffixes at once; yields (d, index into starts, lo, hi)
    for the suffixes that still match d words."""
    n = len(sa)
    live = np.arange(len(starts))
    lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), n, np.int64)
    d = 0
    while len(live):
        live = live[left[starts[live]] > d]
        if len(live) == 0:
            return
        want = test_words[starts[live] + d]

        def bound(upper):
            a, b = lo[live].copy(), hi[live].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    return a
                mid = (a + b) >> 1
                pos = sa[np.minimum(mid, n - 1)]
                # a suffix that ends (its document ends) sorts first
                have = np.where(pos + d < n, words[np.minimum(pos + d, n - 1)], -1)
                right = (have <= want) if upper else (have < want)
                a = np.where(open_ & right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)

        first, last = bound(False), bound(True)
        lo[live], hi[live] = first, last
        live = live[(first < last) & (want >= 0)]
        d += 1
        if len(live):
            yield d, live, lo[live], hi[live]


def shard_matches(texts, test: TestSet, longest: bool = True):
    """Suffix-array search of one shard.  Returns (words per row, row of each
    word, first word of each row, hits) where hits holds arrays (corpus word
    position, test suffix, matched words) of the needed length, and the
    longest match per test suffix (length, lo, hi, sa)."""
    data, off = tb.text_buffer(texts)
    w = tb.split_words(data, off, tb.ALNUM)
    count = np.diff(w.first)
    if len(test.start) == 0 or len(w.offsets) < 2:
        return count, w.first, None
    enc = w.array().dictionary_encode()
    n_ids = len(enc.dictionary)
    code = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # a separator after each document, unlike any word of the benchmark
    rows = np.repeat(np.arange(len(count)), count)
    words = np.full(len(code) + len(count), n_ids, np.int64)
    words[np.arange(len(code)) + rows] = code
    sa = suffix_array(words, n_ids + 1)
    known = pc.index_in(test.values, value_set=enc.dictionary)
    lookup = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    test_words = lookup[test.code]
    found = []
    best = np.zeros(len(test.start), np.int64)
    best_lo, best_hi = np.zeros_like(best), np.zeros_like(best)
    top = int(test.need.max())
    for d, live, lo, hi in search(sa, words, test_words, test.start, test.left):
        hit = test.need[test.start[live]] == d
        if hit.any():
            found.append((live[hit], lo[hit], hi[hit]))
        best[live], best_lo[live], best_hi[live] = d, lo, hi
        if not longest and d >= top:
            break
    return count, w.first, (sa, found, best, best_lo, best_hi)


def _expand(lo, hi):
    """Concatenated ranges lo..hi-1 and the index of the range of each."""
    size = hi - lo
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which], which


def covering_max(lo, hi, value, n):
    """The largest ``value`` of the ranges lo..hi-1 around each of n places, 0
    where there is none.  A range is two overlapping ones of a power of two in
    length; these are handed down to half their length, longest first, so no
    range is ever written out."""
    out = np.zeros(n, np.int64)
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1      # log2, rounded down
    for k in range(int(level.max()) if len(level) else 0, -1, -1):
        at = level == k
        np.maximum.at(out, lo[at], value[at])
        np.maximum.at(out, hi[at] - (1 << k), value[at])
        if k:
            half = 1 << (k - 1)
            down = out.copy()
            np.maximum(down[half:], out[:n - half], out=down[half:])
            out = down
    return out


def _occurrences(found, test, row_of):
    """(row, item), distinct.  Equal windows have the same range of suffixes,
    so their places are looked up once; windows with the same items count once
    in a row."""
    live, lo, hi = (np.concatenate(x) for x in zip(*found))
    item = test.item[test.start[live]]
    window, which = np.unique(np.stack([lo, hi, test.need[test.start[live]]], 1), axis=0, return_inverse=True)
    owner = np.unique(np.stack([which.ravel(), item], 1), axis=0)
    first = np.searchsorted(owner[:, 0], np.arange(len(window) + 1))
    sets, kind = {}, np.zeros(len(window), np.int64)
    for w, (a, b) in enumerate(zip(first[:-1], first[1:])):
        kind[w] = sets.setdefault(owner[a:b, 1].tobytes(), len(sets))
    members = [np.frombuffer(x, np.int64) for x in sets]
    seen = set()
    for at in range(0, len(window), 4096):           # ranges are written out in slices
        place, w = _expand(window[at:at + 4096, 0], window[at:at + 4096, 1])
        seen.update(np.unique(row_of[place] * len(members) + kind[at + w]).tolist())
    return {(x // len(members), i) for x in seen for i in members[x % len(members)].tolist()}


def merge_spans(spans):
    """Sorted, disjoint union of (start, stop) pairs."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def report(texts, test: TestSet):
    """Per row: word count, longest match, merged spans of hit words, ids of
    the items with a window in the row."""
    count, first, got = shard_matches(texts, test)
    rows = len(count)
    spans, items, longest = [[] for _ in range(rows)], [set() for _ in range(rows)], np.zeros(rows, np.int64)
    if got is not None:
        sa, found, best, best_lo, best_hi = got
        starts_sep = first[:-1] + np.arange(rows)        # with separators
        total = int(first[-1]) + rows
        row_of = np.searchsorted(starts_sep, sa, "right") - 1
        cover = np.zeros(total + 1, np.int64)
        if found:
            live, lo, hi = (np.concatenate(x) for x in zip(*found))
            # the longest window that starts at each place
            need = covering_max(lo, hi, test.need[test.start[live]], total)
            np.add.at(cover, sa, need > 0)
            np.add.at(cover, sa + need, -(need > 0).astype(np.int64))
            for r, i in _occurrences(found, test, row_of):
                items[r].add(test.ids[i])
        hit = np.cumsum(cover)[:-1] > 0
        edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            r = int(np.searchsorted(starts_sep, a, "right") - 1)
            spans[r].append((int(a - starts_sep[r]), int(b - starts_sep[r])))
        # every location of a test suffix's longest match
        at = np.flatnonzero(best >= test.need[test.start])
        np.maximum.at(longest, row_of, covering_max(best_lo[at], best_hi[at], best[at], total))
    return count, longest, spans, items


def _blocks(benchmark: DataFrame, item_id: str, text: str, most: int):
    """Benchmark rows in blocks of at most about ``most`` words.  Rows come to
    the driver one partition at a time, one block is held at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text)).where(F.col(text).isNotNull())
    for i, t in rows.toLocalIterator():
        n = len(t) // 2 + 1                     # an upper bound on its words
        if ids and size + n > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += n
    yield ids, texts


def scan(documents: DataFrame, benchmark: DataFrame, *, text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
         shard_bytes: int = SHARD_BYTES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row, n_words, longest, spans, items) for every row of ``documents``:
    ``spans`` are merged [start, stop) word ranges inside occurrences of
    benchmark windows, ``items`` the ids of the items with such a window,
    ``longest`` the longest verbatim match in words (0 below a window)."""
    spark = arrow_session(documents)
    out = row_struct(documents)
    first = True
    for ids, texts in _blocks(benchmark, item_id, item_text, block_words):
        block = spark.sparkContext.broadcast((ids, texts))
        schema = out.schema if not first else T.StructType(
            [out.schema["row"], *T.StructType.fromDDL(RESULT).fields])
        out = out.mapInArrow(_pass(block, window, shard_bytes, text, first), schema)
        first = False
    return out


def _pass(block, window, shard_bytes, text, first):
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        test = TestSet(*block.value, window)
        for t in tb.table_slices(batches, lambda b: struct_field(b, text), shard_bytes):
            t = t.combine_chunks()
            row = t.column("row").combine_chunks()
            n, longest, spans, items = report(pc.struct_field(row, text), test)
            if not first:                       # merge with earlier blocks
                longest = np.maximum(longest, t.column("longest").to_numpy())
                spans = [merge_spans(a + [(x["start"], x["stop"]) for x in b])
                         for a, b in zip(spans, t.column("spans").to_pylist())]
                items = [a | set(b) for a, b in zip(items, t.column("items").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(n, pa.int64()), pa.array(longest, pa.int64()),
                 pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], span),
                 pa.array([sorted(s) for s in items], pa.list_(pa.string()))],
                names=["row", "n_words", "longest", "spans", "items"])
    return run


def locations(documents: DataFrame, benchmark: DataFrame, *, text: str = "text",
              doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text",
              window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """Longest verbatim matches per test suffix and shard: (item_id,
    item_word, n_words, doc_id, doc_word), one row per location, for matches
    of at least a window."""
    spark = arrow_session(documents)
    out = None
    for block in _blocks(benchmark, item_id, item_text, block_words):
        part = documents.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text)).mapInArrow(
            _locate(spark.sparkContext.broadcast(block), window, shard_bytes),
            "item_id string, item_word long, n_words long, doc_id string, doc_word long")
        out = part if out is None else out.union(part)
    return out


def _locate(block, window, shard_bytes):
    def run(batches):
        test = TestSet(*block.value, window)
        item_first = np.searchsorted(test.item, np.arange(len(test.ids)))
        for t in tb.table_slices(batches, lambda b: b.column(1), shard_bytes):
            keys = t.column(0).to_pylist()
            count, first, got = shard_matches(t.column(1), test)
            if got is None:
                continue
            sa, _, best, lo, hi = got
            at = np.flatnonzero(best >= test.need[test.start])
            place, which = _expand(lo[at], hi[at])
            starts_sep = first[:-1] + np.arange(len(count))
            row = np.searchsorted(starts_sep, sa[place], "right") - 1
            suffix = test.start[at[which]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([test.ids[i] for i in test.item[suffix]], pa.string()),
                 pa.array(suffix - item_first[test.item[suffix]], pa.int64()),
                 pa.array(best[at[which]], pa.int64()),
                 pa.array([keys[r] for r in row], pa.string()),
                 pa.array(sa[place] - starts_sep[row], pa.int64())],
                names=["item_id", "item_word", "n_words", "doc_id", "doc_word"])
    return run


def remove(documents: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Documents without any benchmark window, columns unchanged."""
    return scan(documents, benchmark, **kw).where(F.size("items") == 0).select("row.*")


def digest(scanned: DataFrame) -> DataFrame:
    """The result columns of query ``op3_suffix_arrays``."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"))


