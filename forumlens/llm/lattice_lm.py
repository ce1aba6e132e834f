"""Operator 10, language-model scoring by subword lattice likelihood.

The probability of a text is the product of its words' marginal
probabilities and that of one end token.  A word's marginal probability is
the sum over all its segmentations into pieces of an existing vocabulary,
computed by a forward recursion in log space (``lattice.Lattice.marginal``).
The piece weights start from the vocabulary file's scores and are updated with
the pieces' counts in the training rows:

    p(piece) = (count + prior * p0(piece)) / (total + prior)

``base_score`` is the add-0.5 word unigram model over the same tokens: the
counts of all distinct training words are a distributed table.  The commonest
words (at most ``common`` words of at most 64 bytes, so the bound of the
broadcast is known) are looked up inside the tasks with their count and
marginal; every other word goes through a join with the whole table.

Defined results: null and empty texts have one token, the end; a null doc_id
is a training row; repeated rows are each scored (and each counted in
training); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm import textbytes as tb
from forumlens.llm.common import arrow_session, materialize
from forumlens.llm.lattice import Lattice, vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
COUNT_BYTES = 12 << 20       # text bytes whose words are pre-counted together
SCORE_BYTES = 6 << 20        # text bytes scored together
COMMON_WORDS = 200_000       # words looked up inside the tasks ...
COMMON_BYTES = 64            # ... each of at most so many bytes
PRIOR = 32_000.0             # pseudo-count of the vocabulary's own weights


def _words(col):
    data, off = tb.text_buffer(col)
    w = tb.split_words(data, off, tb.NONSPACE)
    enc = w.array().dictionary_encode()
    return enc.dictionary, enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), w.first


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(token, c) of all words of ``texts``; each block of text is counted in
    its task before the shuffle."""
    def run(batches):
        for t in tb.table_slices(batches, lambda b: b.column(0), COUNT_BYTES):
            values, code, _ = _words(t.column(0))
            yield pa.RecordBatch.from_arrays(
                [values.cast(pa.large_string()).cast(pa.string()),
                 pa.array(np.bincount(code, minlength=len(values)).astype(np.int64))],
                names=["token", "c"])

    return (texts.select(text).mapInArrow(run, "token string, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


def piece_counts(counts: DataFrame, model: str) -> DataFrame:
    """(piece, c): pieces of the training words, by the vocabulary's own
    segmentation; at most one row per piece of the vocabulary."""
    def run(batches):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        total = np.zeros(sp.get_piece_size(), np.int64)
        for b in batches:
            ids = sp.encode(b.column(0).to_pylist(), num_threads=1)
            c = np.repeat(b.column(1).to_numpy(), [len(x) for x in ids])
            flat = np.fromiter((i for x in ids for i in x), np.int64, len(c))
            total += np.bincount(flat, weights=c, minlength=len(total)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["piece", "c"])

    return (counts.select("token", "c").mapInArrow(run, "piece long, c long")
            .groupBy("piece").agg(F.sum("c").alias("c")))


class Model:
    """Natural-log piece weights and the end's log10 probability."""

    def __init__(self, model: str, pieces: np.ndarray, counts: np.ndarray, ends: int,
                 prior: float = PRIOR):
        p0 = np.exp(vocabulary(model).rank_weights())
        c = np.zeros(len(p0))
        c[pieces] = counts
        c[p0 == 0] = 0                 # pieces that no lattice edge can spell
        total = c.sum() + ends + 1 + prior
        self.model = model
        with np.errstate(divide="ignore"):
            self.logp = np.log((c + prior * p0) / total)
        self.end = float(np.log10((ends + 1) / total))

    def words(self, values: pa.Array) -> np.ndarray:
        """log10 marginal probability of each word (large_binary)."""
        if len(values) == 0:
            return np.empty(0)
        lat = Lattice(vocabulary(self.model), values, space_prefix=True)
        return lat.marginal(self.logp) / np.log(10)


def _binary(col) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_string()).cast(pa.large_binary())


def score(docs: DataFrame, *, train: Column, text: str = "text", keys=("doc_id",),
          model: str = MODEL, common: int = COMMON_WORDS, prior: float = PRIOR) -> DataFrame:
    """Score every row of ``docs``; learn from the rows where ``train`` holds.
    Returns ``keys`` and n_tokens, n_known, train_tokens, base_score, score."""
    spark = arrow_session(docs)
    sc = spark.sparkContext
    rows = docs.where(train)
    counts = materialize(word_counts(rows, text), "counts")
    ends = rows.count()
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = (n or 0) + ends, v + (1 if ends else 0)
    denom = n + 0.5 * (v + 1)
    pieces = piece_counts(counts, model).toPandas()
    lm = sc.broadcast(Model(model, pieces["piece"].to_numpy(np.int64),
                            pieces["c"].to_numpy(np.float64), ends, prior))

    def add_marginal(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lm.value.words(_binary(b.column(0))))],
                names=["token", "c", "lp"])

    top = (counts.where(F.octet_length("token") <= COMMON_BYTES)
           .orderBy(F.desc("c"), "token").limit(common)
           .repartition(sc.defaultParallelism)
           .mapInArrow(add_marginal, "token string, c long, lp double").toArrow())
    table = sc.broadcast((_binary(top["token"]), top["c"].to_numpy(), top["lp"].to_numpy()))
    n_keys = len(keys)

    def run(batches):
        words, word_c, word_lp = table.value
        base = np.log10((word_c + 0.5) / denom)
        end_base = np.log10((ends + 0.5) / denom)
        for t in tb.table_slices(batches, lambda b: b.column(n_keys), SCORE_BYTES):
            values, code, first = _words(t.column(n_keys))
            size = np.diff(first)
            row = np.repeat(np.arange(len(size)), size)
            at = pc.fill_null(pc.index_in(values, value_set=words), -1).to_numpy(zero_copy_only=False)
            known = at >= 0
            lp, b, k = np.zeros(len(values)), np.zeros(len(values)), np.zeros(len(values))
            lp[known], b[known], k[known] = word_lp[at[known]], base[at[known]], 1
            lp[~known] = lm.value.words(values.take(pa.array(np.flatnonzero(~known))))

            def per_row(x):
                return np.bincount(row, weights=x[code], minlength=len(size))

            rare = ~known[code]
            pair, tf = np.unique(row[rare] * len(values) + code[rare], return_counts=True)
            at_row, word = pair // max(len(values), 1), pair % max(len(values), 1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(at_row, np.arange(len(size) + 1)).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [values.take(pa.array(word)).cast(pa.large_string()).cast(pa.string()),
                     pa.array(tf.astype(np.int64))], names=["token", "tf"]))
            t = t.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*(t.column(i).combine_chunks() for i in range(n_keys)),
                 pa.array(size + 1, pa.int64()),
                 pa.array(per_row(k).astype(np.int64) + (1 if ends else 0)),
                 pa.array(per_row(b) + end_base), pa.array(per_row(lp) + lm.value.end), lists],
                names=[*keys, "n_tokens", "n_known", "base_score", "score", "rare"])

    kept = docs.select(*keys, text)
    key_ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    scored = kept.mapInArrow(run, f"{key_ddl}n_tokens long, n_known long, base_score double, "
                                  "score double, rare array<struct<token:string,tf:long>>")
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    more = (scored.select("_row", F.inline("rare")).join(counts, "token", "left")
            .groupBy("_row").agg(
                F.sum(F.col("tf") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / denom)).alias("b"),
                F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("k")))
    return (scored.drop("rare").join(more, "_row", "left")
            .select(*keys, "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
                    F.lit(int(n)).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("b", F.lit(0.0))).alias("base_score"), "score"))
