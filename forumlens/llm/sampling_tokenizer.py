"""Operator 6, SentencePiece encoding and decoding by forward filtering and
backward sampling over the piece lattice.

Every text is segmented by one draw from the distribution over all its
segmentations, each weighted by the product of its pieces' weights to the
power ``alpha`` (weights from the vocabulary file alone, see
``Vocabulary.rank_weights``).  The draw is seeded by the row key, the place
in the text and ``seed``, so a recomputed task, another partitioning or
another batch size give the same segmentation.  Decoding is the
concatenation of the pieces' bytes and gives back every text byte for byte.

Defined results: a null text has null ids and decodes to null; an empty text
has no ids; a null row key counts as the empty key; rows with equal key and
text get equal ids; other columns ride along in one struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm import textbytes as tb
from forumlens.llm.common import arrow_session, row_struct, struct_field
from forumlens.llm.lattice import Lattice, Sampler, units, vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20        # text bytes handled at once (one longer text alone)


def encode_batch(texts, keys, vocab, logp, seed: int):
    """(ids, first id of each row, lossless per row) of a column of texts;
    ``keys`` is a uint64 per row."""
    data, off = tb.text_buffer(texts)
    distinct, which, first = units(data, off)
    count = np.diff(first)
    with np.errstate(over="ignore"):
        row = tb.mix(keys + np.uint64(seed) * tb._M1)
        place = np.arange(len(which)) - np.repeat(first[:-1], count)
        seeds = tb.mix(np.repeat(row, count) ^ tb.mix(place.astype(np.uint64)))
    if len(which) == 0:
        return np.empty(0, np.int32), np.zeros(len(off), np.int64), np.ones(len(count), bool)
    ids, at = Sampler(Lattice(vocab, distinct), logp).sample(which, seeds)
    rows = at[first]
    back = vocab.decode(ids)
    size = vocab.raw_offsets[ids + 1] - vocab.raw_offsets[ids]
    ends = np.concatenate([[0], np.cumsum(size)])[rows]
    same = ends[1:] - ends[:-1] == off[1:] - off[:-1]
    if len(back) == len(data):
        wrong = np.flatnonzero(back != data)
        same &= np.diff(np.searchsorted(wrong, off)) == 0
    else:
        same = np.array([np.array_equal(back[ends[i]:ends[i + 1]], data[off[i]:off[i + 1]])
                         for i in range(len(same))])
    return ids, rows, same


def encode(docs: DataFrame, *, text: str = "text", key: str | Column = "doc_id",
           model: str = MODEL, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """(row, ids array<int>, lossless) for every row: a sampled segmentation,
    and whether it decodes to the text."""
    arrow_session(docs)
    key = F.col(key) if isinstance(key, str) else key

    def run(batches):
        vocab = vocabulary(model)
        logp = alpha * vocab.rank_weights()
        for t in tb.table_slices(batches, lambda b: struct_field(b, text), BLOCK_BYTES):
            row = t.column("row").combine_chunks()
            texts = pc.struct_field(row, text)
            keys = t.column("key").to_numpy().astype(np.uint64)
            ids, at, same = encode_batch(texts, keys, vocab, logp, seed)
            null = pc.is_null(texts).to_numpy(zero_copy_only=False)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids),
                                             mask=pa.array(null))
            yield pa.RecordBatch.from_arrays([row, lists, pa.array(same)],
                                             names=["row", "ids", "lossless"])

    rows = row_struct(docs, F.xxhash64(key).alias("key"))
    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], *T.StructType.fromDDL("ids array<int>, lossless boolean").fields]))


def decode(encoded: DataFrame, *, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The columns of ``encoded`` in ``row`` and the decoded ``text``."""
    arrow_session(encoded)

    def run(batches):
        vocab = vocabulary(model)
        for b in batches:
            row = b.column(0)
            col = pc.struct_field(row, ids)
            flat, size = col.flatten().to_numpy().astype(np.int64), pc.fill_null(pc.list_value_length(col), 0)
            at = np.concatenate([[0], np.cumsum(size.to_numpy())])
            raw = np.concatenate([[0], np.cumsum(vocab.raw_offsets[flat + 1] - vocab.raw_offsets[flat])])
            texts = tb.binary_array(vocab.decode(flat), raw[at]).cast(pa.large_string())
            texts = pc.if_else(pc.is_null(col), pa.scalar(None, pa.large_string()), texts)
            yield pa.RecordBatch.from_arrays([row, texts.cast(pa.string())], names=["row", "text"])

    rows = row_struct(encoded)
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
