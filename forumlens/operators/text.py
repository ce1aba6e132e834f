"""Text cleaning and features.

Two hashing-trick forms:
* ``hashed_tf``: long form ``(id, bucket, tf)`` with a portable md5 bucket,
  the same in any SQL engine (oracle-checkable, and the layout the one-pass
  multi-model scorer joins on);
* ``vectorizer``: the ML pipeline (tokenizer -> stop words -> HashingTF)
  producing a sparse Vector column for the ML estimators.
"""

from __future__ import annotations

import hashlib
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.constants import NUM_FEATURES
from forumlens.functions.arrays import row_ranges
from forumlens.functions.hashing import md5_bucket
from forumlens.functions.text import post_text, tokenize_expr
from forumlens.session import ship_package

# words that are counted at once in Python
WORDS_AT_ONCE = 1 << 20


def default_stop_words() -> list[str]:
    """Spark's public English stop-word list, shipped as a text file."""
    text = resources.files("forumlens.resources").joinpath(
        "english_stopwords.txt").read_text(encoding="utf-8")
    return [w for w in text.splitlines() if w]


def clean_text(df: DataFrame, title: str | None = "Title", body: str = "Body",
               out: str = "Text") -> DataFrame:
    """plain, word-character-only text from title and markup body."""
    t = F.col(title) if title else F.lit("")
    return df.withColumn(out, post_text(t, F.col(body)))


def tokenize(df: DataFrame, text: str = "Text", out: str = "tokens",
             keep_empty: bool = False) -> DataFrame:
    """Lower-case, split on each whitespace char (see ``tokenize_expr``)."""
    return df.withColumn(out, tokenize_expr(text, keep_empty))


def remove_stop_words(df: DataFrame, tokens: str = "tokens",
                      words: list[str] | None = None,
                      out: str = "words") -> DataFrame:
    """Drop stop words (case-insensitive) with ``StopWordsRemover``
    (a JVM hash-set lookup per token; 4x faster than an inlined
    ``array_contains`` over the list)."""
    words = default_stop_words() if words is None else words
    return StopWordsRemover(inputCol=tokens, outputCol=out, stopWords=words,
                            caseSensitive=False).transform(df)


def remove_stop_words_table(df: DataFrame, words: DataFrame, id_col: str = "Id", tokens: str = "tokens",
                            out: str = "words", word: str = "word") -> DataFrame:
    """X2 for a word list of any size, ``words (word)``, as a table: each
    row's distinct tokens are laid out, those whose lower case is that of a
    listed word stay in a semi-join, and leave the row's tokens when they
    come back to it.  Only the listed words of each row and, once, the tokens
    themselves are shuffled by ``id_col``, not a row for every token.

    ``id_col`` tells the rows of ``df`` apart (rows that share one get the
    tokens of all of them, by place; rows without one keep none); the result
    has it and ``out``, an empty array where no token is left, null for null
    tokens.  A frequent token is a hot key of the semi-join, which Spark's
    skew join splits, as each word is on the other side once.
    """
    stop = words.select(F.lower(word).alias("_w")).where(F.col("_w").isNotNull()).distinct()
    rows = explode_tokens(df.select(id_col, F.array_distinct(tokens).alias("_distinct")), id_col, "_distinct", "_pos", "_token")
    listed = rows.join(stop, F.lower("_token") == F.col("_w"), "left_semi").groupBy(id_col).agg(F.collect_set("_token").alias("_listed"))
    kept = F.filter(tokens, lambda t: t.isNotNull() & ~F.array_contains("_listed", t))
    kept = F.when(F.col("_listed").isNull(), F.filter(tokens, lambda t: t.isNotNull())).otherwise(kept)
    both = df.select(id_col, tokens).join(listed, id_col, "left")
    same_id = Window.partitionBy(id_col)
    places = F.filter(F.transform(tokens, lambda t, i: F.struct(i.alias("_pos"), t.alias("_token"))),
                      lambda s: s["_token"].isNotNull() & ~F.coalesce(F.array_contains("_listed", s["_token"]), F.lit(False)))
    both = both.withColumn("_n", F.count(F.lit(1)).over(same_id))
    both = both.withColumn("_all", F.collect_list(F.when((F.col("_n") > 1) & F.col(id_col).isNotNull(), places)).over(same_id))
    none = F.when(F.col(tokens).isNotNull(), F.array().cast("array<string>"))
    merged = F.sort_array(F.flatten("_all"))["_token"]
    return both.select(id_col, F.when(F.col(id_col).isNull(), none).when(F.col("_n") == 1, kept)
                       .when(F.size(merged) > 0, merged).otherwise(none).alias(out))


def hashed_tf(df: DataFrame, id_col: str = "Id", words: str = "words",
              num_features: int = NUM_FEATURES,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """X3 long form: ``(id, bucket, tf)`` term counts per hashed bucket.

    Documents are independent, so the counting happens inside each row with
    built-in array functions and no shuffle: the bucket array is sorted once
    (its own column, so the lambdas below do not recompute it), run starts
    are found by comparing neighbours, and run lengths are the counts.  The
    rows of a document stay in its partition, so a later per-document
    aggregation (e.g. scoring) combines them map-side.  Columns in ``keep``
    (per-document attributes such as labels) are carried to every output row.
    """
    b = F.col("_b")
    keep = list(keep)
    with_b = df.select(id_col, *keep, F.array_sort(F.transform(
        words, lambda w: md5_bucket(w, num_features))).alias("_b"))
    starts = with_b.select(id_col, *keep, "_b", F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(b), F.lit(1))),
        lambda i: (i == 1) | (F.element_at(b, i) != F.element_at(b, i - 1))).alias("_s"))
    st = F.col("_s")
    ends = F.concat(F.slice(st, 2, F.greatest(F.size(st), F.lit(1))),
                    F.array(F.size(b) + 1))
    pairs = F.arrays_zip(
        F.transform(st, lambda i: F.element_at(b, i)).alias("bucket"),
        F.zip_with(st, ends, lambda a, e: (e - a).cast("bigint")).alias("tf"))
    # explode_outer + null filter: see ``explode_tokens``
    out = starts.select(id_col, *keep,
                        F.explode_outer(F.when(F.size(b) > 0, pairs)).alias("_p"))
    return out.where(F.col("_p").isNotNull()).select(
        id_col, *keep, F.col("_p.bucket").alias("bucket"), F.col("_p.tf").alias("tf"))


def _bucket_counts(words: pa.ListArray, num_features: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Sorted buckets of each row's words and how often each occurs.  A null
    word counts as one of the row's last bucket, which is null if the row has
    no others."""
    lengths, flat = np.asarray(words.value_lengths().fill_null(0), np.int64), words.flatten()
    coded = flat.dictionary_encode()
    prefixes = b"".join(hashlib.md5(w, usedforsecurity=False).digest()[:4] for w in coded.dictionary.cast(pa.binary()).to_pylist())
    buckets = np.frombuffer(prefixes, ">u4").astype(np.int64) % num_features
    owner, code = np.repeat(np.arange(len(words)), lengths), np.asarray(coded.indices.fill_null(-1), np.int64)
    last = np.full(len(words), num_features)
    if flat.null_count:
        last[:] = -1
        np.maximum.at(last, owner[code >= 0], buckets[code[code >= 0]])
        last[last < 0] = num_features
    bucket = np.where(code >= 0, np.append(buckets, 0)[code], last[owner])
    keys, counts = np.unique(owner * (num_features + 1) + bucket, return_counts=True)
    owner, bucket = np.divmod(keys, num_features + 1)
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]).astype(np.int32))
    return (pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int32), mask=bucket == num_features)),
            pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.float64))))


def hashed_tf_arrays(df: DataFrame, words: str = "words", num_features: int = NUM_FEATURES) -> DataFrame:
    """X3 as two arrays per row, ``buckets`` (sorted) and ``tf``; the other
    columns are kept.  The layout of ``joint.score_posts``.

    The buckets are those of ``md5_bucket``, made once for each distinct word
    of an Arrow batch (or of ``WORDS_AT_ONCE`` words of it).
    """
    ship_package(df.sparkSession)
    keep, at_once = [c for c in df.columns if c != words], WORDS_AT_ONCE
    rows = df.select(*keep, words)
    schema = T.StructType([f for f in rows.schema if f.name != words]
                          + [T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.DoubleType()))])

    def count(batches):
        for batch in batches:
            lengths = np.asarray(batch.column(len(keep)).value_lengths().fill_null(0), np.int64)
            for a, b in row_ranges(lengths, batch.num_rows, at_once):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *_bucket_counts(part.column(len(keep)), num_features)],
                                                 names=[*keep, "buckets", "tf"])

    return rows.mapInArrow(count, schema)


def text_features(df: DataFrame, id_col: str = "Id", text: str = "Text",
                  words: list[str] | None = None,
                  num_features: int = NUM_FEATURES,
                  keep_empty: bool = False) -> DataFrame:
    """Cleaned text -> tokens -> stop words out -> long-form hashed tf."""
    toks = tokenize(df.select(id_col, text), text, keep_empty=keep_empty)
    return hashed_tf(remove_stop_words(toks, words=words), id_col,
                     num_features=num_features)


def vectorizer(input_col: str = "Text", words: list[str] | None = None,
               num_features: int = NUM_FEATURES, keep_empty: bool = False,
               output_col: str = "features") -> Pipeline:
    """The three-stage ML vectorizer as one Pipeline (X1 -> X2 -> X3).

    ``keep_empty=True`` uses ``Tokenizer`` (inner empty tokens kept, the
    reference's behaviour); the default uses a ``RegexTokenizer`` with the
    same single-whitespace split that drops empty tokens.
    """
    if keep_empty:
        tok = Tokenizer(inputCol=input_col, outputCol="_tokens")
    else:
        tok = RegexTokenizer(inputCol=input_col, outputCol="_tokens",
                             pattern=r"\s", gaps=True, minTokenLength=1,
                             toLowercase=True)
    stop = StopWordsRemover(inputCol="_tokens", outputCol="_words",
                            stopWords=default_stop_words() if words is None else words)
    tf = HashingTF(inputCol="_words", outputCol=output_col,
                   numFeatures=num_features)
    return Pipeline(stages=[tok, stop, tf])


def explode_tokens(df: DataFrame, id_col: str, tokens: str,
                   pos: str = "pos", out: str = "token") -> DataFrame:
    """Long form ``(id, pos, token)`` of a token array (see ``hashed_tf`` for
    why this uses the outer form plus a filter)."""
    return (df.select(id_col, F.posexplode_outer(tokens).alias(pos, out))
            .where(F.col(out).isNotNull()))


def vectorize(df: DataFrame, text: str = "Text", **kw) -> DataFrame:
    """X4 + X6: add the feature vector; drop the intermediate columns."""
    out = vectorizer(text, **kw).fit(df).transform(df)
    return out.drop("_tokens", "_words")
