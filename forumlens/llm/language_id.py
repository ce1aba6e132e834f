"""Operator 5, language identification by nearest centroid.

A text becomes a hashed vector of its byte 1-, 2- and 3-grams (A-Z
lower-cased, runs of ASCII non-letters as one space), weighted by
(1 + log tf) * idf and normalised.  Each language has several centroids
(spherical k-means over a sample of its training texts); a text takes the
language of the centroid with the largest cosine.  A text farther from its
centroid than nearly all training texts of that centroid were (``REJECT_SHARE``
of the ``REJECT_QUANTILE`` of their cosines) is rejected.  Texts of less than
``SHORT_BYTES`` bytes lie farther out: half the limit holds for them.

The model is fitted on a bounded sample of the labelled rows:
``PER_LANGUAGE`` distinct texts per language, chosen by hash.  Everything that leaves the
tasks (document frequencies, centroids, cosines) has a fixed size per language.

Defined results: a null text, or one without any Unicode letter, is ``und``
with score 0 and rejected; without training rows every text is ``und``; ties
take the language first in order; other columns ride along in one struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm import textbytes as tb
from forumlens.llm.common import arrow_session, materialize, row_struct, struct_field

DIM_BITS = 13                # hashed n-gram dimensions
PER_LANGUAGE = 1500          # distinct training texts sampled per language
SPARE = 4                    # times as many hashes are ranked for the sample
CENTROIDS = 4                # clusters per language
ROUNDS = 8                   # of k-means
REJECT_QUANTILE = 0.001      # of the training cosines ...
REJECT_SHARE = 0.85          # ... times this is the least cosine accepted
SHORT_BYTES = 200            # texts below it are short ...
SHORT_SHARE = 0.5            # ... and need this part of the least cosine
ROWS = 256                   # rows of a dense block
BLOCK_BYTES = 4 << 20
UND = "und"

# A-Z to a-z; other ASCII to space
_CLASS = np.where((tb.LOWER >= 97) & (tb.LOWER <= 122) | (tb.LOWER >= 128), tb.LOWER, 32).astype(np.uint8)


def counts(texts) -> np.ndarray:
    """Hashed n-gram counts, one row per text (at most ``ROWS`` rows)."""
    data, off = tb.text_buffer(texts)
    n, dim = len(off) - 1, 1 << DIM_BITS
    c = _CLASS[data]
    row = np.repeat(np.arange(n), np.diff(off))
    first = np.ones(len(c), bool)
    first[1:] = row[1:] != row[:-1]
    keep = c != 32
    keep[1:] |= (c[:-1] != 32) & ~first[1:]         # the first space of a run stays
    c, row = c[keep].astype(np.uint32), row[keep]
    out = np.zeros(n * dim)
    gram = np.zeros(len(c), np.uint32)
    for k in range(3):
        m = len(c) - k
        if m <= 0:
            break
        gram = (gram[:m] << np.uint32(8)) | c[k:k + m]
        with np.errstate(over="ignore"):
            h = ((gram + np.uint32(k * 0x5BD1E995)) * np.uint32(2654435761)) >> np.uint32(32 - DIM_BITS)
        on = row[:m] == row[k:k + m]
        out += np.bincount(row[:m][on] * dim + h[on], minlength=n * dim)
    return out.reshape(n, dim)


def vectors(texts, idf: np.ndarray) -> np.ndarray:
    x = counts(texts)
    x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _slices(batches, get):
    for t in tb.table_slices(batches, get, BLOCK_BYTES):
        t = t.combine_chunks()
        for lo in range(0, t.num_rows, ROWS):
            yield t.slice(lo, ROWS)


class Model:
    """Languages, inverse document frequencies, centroids, and the least
    cosine that each centroid accepts."""

    def __init__(self, idf, langs, centroids, least):
        self.idf, self.langs, self.centroids, self.least = idf, langs, centroids, least

    def predict(self, texts):
        """(centroid index, cosine) per text."""
        sim = vectors(texts, self.idf) @ self.centroids.T
        best = sim.argmax(1)
        return best, np.clip(sim[np.arange(len(best)), best], 0, 1)

    def rejects(self, texts, best, cos):
        short = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) < SHORT_BYTES
        return cos < self.least[best] * np.where(short, SHORT_SHARE, 1)


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from spread-out starting points."""
    centre = [x.mean(0)]
    near = x @ centre[0]
    while len(centre) < min(k + 1, len(x) + 1):
        centre.append(x[near.argmin()])
        near = np.maximum(near, x @ centre[-1])
    c = np.stack(centre[1:])
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
    return c


def _sampled(rows: DataFrame, per_language: int) -> DataFrame:
    """(lang, h): the ``per_language`` smallest text hashes of each language.
    Only keys move.  The hashes are even, so a share of their range that holds
    ``SPARE`` times as many as wanted leaves a bounded number to rank."""
    keys = materialize(rows.select("lang", "h").distinct(), "keys")
    n = keys.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.col("h") / F.lit(2.0 ** 64) + 0.5                 # 0 to 1
    near = keys.join(F.broadcast(n), "lang").where(place * F.col("n") <= SPARE * per_language)
    order = Window.partitionBy("lang").orderBy("h")
    return near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).select("lang", "h")


def fit(docs: DataFrame, *, train: Column, text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Learn from the rows where ``train`` holds and text and lang are given."""
    arrow_session(docs)
    rows = (docs.where(train).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where(r"text is not null and lang is not null and text rlike '\\p{L}'")
            .withColumn("h", F.xxhash64("text")))
    sample = materialize(rows.join(F.broadcast(_sampled(rows, per_language)), ["lang", "h"])
                         .groupBy("lang", "h").agg(F.min("text").alias("text"))
                         .select("lang", "text"), "sample")
    dim = 1 << DIM_BITS

    def frequency(batches):
        df, n = np.zeros(dim, np.int64), 0
        for t in _slices(batches, lambda b: b.column(0)):
            df += (counts(t.column(0)) > 0).sum(0)
            n += t.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array(df), pa.array(np.full(dim, n))],
            names=["i", "df", "n"])

    total = (sample.select("text").mapInArrow(frequency, "i int, df long, n long")
             .groupBy("i").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).orderBy("i").toPandas())
    if not len(total) or not total["n"].iloc[0]:
        return Model(np.ones(dim), [], np.zeros((0, dim)), np.zeros(0))
    idf = np.log((total["n"].to_numpy() + 1) / (total["df"].to_numpy() + 1)) + 1

    def cluster(table: pa.Table) -> pa.Table:
        x = np.concatenate([vectors(table["text"].slice(a, ROWS), idf).astype(np.float32)
                            for a in range(0, table.num_rows, ROWS)])
        c = _cluster(x, centroids)
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(c)),
                         "c": pa.array([v.astype(np.float64).tobytes() for v in c], pa.binary())})

    rows = sorted(sample.groupBy("lang").applyInArrow(cluster, "lang string, c binary").collect())
    model = Model(idf, [r["lang"] for r in rows],
                  np.stack([np.frombuffer(bytes(r["c"]), np.float64) for r in rows]), np.zeros(len(rows)))

    def cosines(batches):
        for t in _slices(batches, lambda b: b.column(0)):
            best, x = model.predict(t.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.int32()), pa.array(x)], names=["c", "x"])

    low = (sample.where(F.octet_length("text") >= SHORT_BYTES).select("text").mapInArrow(cosines, "c int, x double")
           .groupBy("c").agg(F.percentile_approx("x", REJECT_QUANTILE, 10_000).alias("x")))
    for r in low.collect():                     # one row per centroid
        model.least[r["c"]] = REJECT_SHARE * r["x"]
    return model


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """(row, lang_pred, score, rejected) for every row."""
    spark = arrow_session(docs)
    known = spark.sparkContext.broadcast(model)

    def run(batches):
        m = known.value
        for t in _slices(batches, lambda b: struct_field(b, text)):
            row = t.column("row").combine_chunks()
            n = len(row)
            letter = t.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            if m.langs:
                best, cos = m.predict(pc.struct_field(row, text))
                far = m.rejects(pc.struct_field(row, text), best, cos)
            else:
                best, cos, far, letter = np.zeros(n, int), np.zeros(n), np.ones(n, bool), np.zeros(n, bool)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array([m.langs[b] if on else UND for b, on in zip(best, letter)], pa.string()),
                 pa.array(np.where(letter, cos, 0.0)), pa.array(~letter | far)],
                names=["row", "lang_pred", "score", "rejected"])

    rows = row_struct(docs, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], *T.StructType.fromDDL("lang_pred string, score double, rejected boolean").fields]))


def accepted(docs: DataFrame, model: Model, **kw) -> DataFrame:
    """The documents that the model does not reject, columns unchanged."""
    return predict(docs, model, **kw).where(~F.col("rejected")).select("row.*")
