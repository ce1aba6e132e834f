"""Corpus pipeline: five stages of ``forumlens.llm`` over ``documents``.

Each stage takes what the one before it kept, written as Parquet and read
again; all but the last return the columns of ``documents``.

1. language ID: documents that the model rejects go;
2. line dedup: near copies of earlier documents go whole, so that none is cut
   to the lines in which it differs; then repeated chunks of lines go, and a
   document of which nothing is left goes too;
3. n-gram Jaccard join: one document of each group stays;
4. benchmark decontamination: documents with a benchmark window go;
5. SentencePiece encoding: sampled piece ids and whether they decode to the
   text.
"""

from __future__ import annotations

import gc
import os
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import decontaminate, language_id, line_chunks, sampling_tokenizer, signature_join
from forumlens.llm.common import held_out, materialize, read_table
from forumlens.session import delete_path, discard, staging


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs, train=~held_out("doc_id", 4, 2))
    return language_id.accepted(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_chunks.dedup(line_chunks.without_copies(docs)).where("lines_removed = 0 or row.text <> ''")
    n_chars = F.when(F.col("lines_removed") > 0, F.length("row.text")).otherwise(F.col("row.n_chars"))
    return out.select(*((n_chars.cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"row.`{c}`")).alias(c)
                        for c in docs.columns))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return signature_join.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = sampling_tokenizer.encode(docs.select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_pieces"),
                      "lossless", "ids")


_LEFT: list[str] = []          # folders of tables that earlier stages staged


def _tidy(spark: SparkSession, docs: DataFrame) -> None:
    """Delete what earlier stages staged, once their output is written: as
    long as the rows of ``docs`` still come from it, it stays."""
    files = docs.inputFiles()
    for path in [p for p in _LEFT if not any(os.path.basename(p) in f for f in files)]:
        delete_path(spark, path)
        _LEFT.remove(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()        # Spark then drops the shuffles of finished stages


def _stage(name: str, function):
    """The stage in a folder of its own for what it stages."""
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _tidy(spark, docs)
        with staging(spark, name) as path:
            out = function(spark, docs, sf_dir)
        _LEFT.append(path)
        return out
    return name, run


STAGES = [
    _stage("language_id", identify_language),
    _stage("line_dedup", dedup_lines),
    _stage("ngram_jaccard_join", join_near_duplicates),
    _stage("benchmark_decontamination", remove_benchmark),
    _stage("sentencepiece", encode_pieces),
]

# language ID and sampled segmentations are not expressible in SQL; tests
# compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
