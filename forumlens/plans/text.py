"""Text queries: cleaning, tokens, stop words, hashed term frequencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.functions.tags import has_tag
from forumlens.operators import text as X
from forumlens.plans import sql
from forumlens.plans.registry import query
from forumlens.session import materialize, shared_path
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt

NUM_FEATURES = X.NUM_FEATURES

# Java \s and \S written as explicit classes (RE2's \s lacks \x0B)
_WS = "[ \\t\\n\\x0B\\f\\r]"
_NWS = "[^ \\t\\n\\x0B\\f\\r]"


def _sql_post_text(title: str, body: str) -> str:
    t = (f"coalesce({title}, '') || ' ' || "
         f"regexp_replace(coalesce({body}, ''), '<{_NWS}+>', ' ', 'g')")
    t = f"replace({t}, chr(10), ' ')"
    t = f"regexp_replace({t}, '( )+', ' ', 'g')"
    return f"regexp_replace({t}, '\\W', ' ', 'g')"


def _sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{_WS}'), lambda x: x <> '')"


def _sql_stop_list() -> str:
    words = X.default_stop_words()
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _sql_words(text: str) -> str:
    return (f"list_filter({_sql_tokens(text)}, "
            f"lambda x: NOT list_contains({_sql_stop_list()}, lower(x)))")


@query("clean_text", f"""SELECT page_id AS Id, {_sql_post_text('url', 'html')} AS Text
FROM pages""")
def clean_text(spark, sf):
    p = fx.page_posts(spark, sf)
    return X.clean_text(p, "Title", "Body").select("Id", "Text")


def _long_form_sql(array_sql: str) -> str:
    return f"""SELECT Id, CAST(pos AS INTEGER) AS pos, token FROM (
  SELECT Id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS token
  FROM (SELECT doc_id AS Id, {array_sql} AS a FROM documents))"""


@query("tokenize", _long_form_sql(_sql_tokens("text")))
def tokenize(spark, sf):
    d = fx.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "text")
    return X.explode_tokens(X.tokenize(d, "text"), "Id", "tokens")


_CLEAN_DOC = _sql_post_text("NULL", "text")


@query("tok_stopwords", _long_form_sql(_sql_words(_CLEAN_DOC)))
def tok_stopwords(spark, sf):
    d = fx.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "text")
    w = X.remove_stop_words(X.tokenize(X.clean_text(d, None, "text"), "Text"))
    return X.explode_tokens(w, "Id", "words")


@query("stopwords_file", _long_form_sql(_sql_words(_CLEAN_DOC)))
def stopwords_file(spark, sf):
    """S5 + X2: the stop words written as a text file in the shared folder,
    read back as a table and taken out by an anti-join."""
    path = shared_path(spark, "stopwords")
    spark.createDataFrame([(w,) for w in X.default_stop_words()], "value string").write.text(path)
    d = fx.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "text")
    tokens = materialize(X.tokenize(X.clean_text(d, None, "text"), "Text").select("Id", "tokens"), "tokens")
    return X.explode_tokens(X.remove_stop_words_table(tokens, fmt.read_word_list(spark, path)), "Id", "words")


@query("tokenize_keep_empty", f"""SELECT Id, CAST(pos AS INTEGER) AS pos, token FROM (
  SELECT Id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS token FROM (
    SELECT Id, a[:len(a) - coalesce(list_position(list_transform(list_reverse(a), lambda x: x <> ''), TRUE), len(a) + 1) + 1] AS a
    FROM (SELECT doc_id AS Id, regexp_split_to_array(lower(text), '{_WS}') AS a FROM documents)))""")
def tokenize_keep_empty(spark, sf):
    """X1 as the ML tokenizer has it (T11): inner empty tokens stay, trailing
    ones go."""
    d = fx.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "text")
    return X.explode_tokens(X.tokenize(d, "text", keep_empty=True), "Id", "tokens")


@query("hashed_tf", f"""SELECT Id, {sql.md5_bucket('w', NUM_FEATURES)} AS bucket, count(*) AS tf
FROM (SELECT doc_id AS Id, unnest({_sql_words(_CLEAN_DOC)}) AS w FROM documents)
GROUP BY ALL""")
def hashed_tf(spark, sf):
    d = fx.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "text")
    return X.text_features(X.clean_text(d, None, "text"), "Id", "Text")


# ---- the estimators' hash (32-bit murmur3, seed 42) in SQL ---------------------

_32 = 4294967296
C1, C2, ADD, SEED = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 42
FINAL1, FINAL2 = 0x85EBCA6B, 0xC2B2AE35


def _rotl(x: str, n: int) -> str:
    return f"(((({x}) << {n}) | (({x}) >> {32 - n})) & {_32 - 1})"


def _sql_word(at: str) -> str:
    """Four bytes of the hex string ``h``, the first the lowest."""
    byte = [f"substr(h, {at} + {i}, 2)" for i in (6, 4, 2, 0)]
    return f"CAST('0x' || {' || '.join(byte)} AS UBIGINT)"


def _sql_hash_ctes(words: str) -> str:
    """``hashed`` (w, bucket) for the distinct words of the CTE ``words``;
    one step of the hash per CTE column, so that none is written out twice."""
    mixed = f"list_transform(ks, lambda k: {_rotl(f'k * {C1} % {_32}', 15)} * {C2} % {_32})"
    step = _rotl("xor(a, k)", 13)
    return f"""hw AS (SELECT w, strlen(w) AS n, hex(w) || '00000000' AS h FROM (SELECT DISTINCT w FROM {words})),
hk AS (SELECT w, n, list_transform(range(0, n // 4 + 1), lambda i: {_sql_word('8 * i + 1')}) AS ks FROM hw),
hm AS (SELECT w, n, {mixed} AS ms FROM hk),
h1 AS (SELECT w, n, xor(list_reduce(list_prepend(CAST({SEED} AS UBIGINT), ms[:n // 4]),
         lambda a, k: ({step} * 5 + {ADD}) % {_32}), ms[n // 4 + 1]) AS x FROM hm),
h2 AS (SELECT w, xor(x, n::UBIGINT) AS x FROM h1),
h3 AS (SELECT w, xor(x, x >> 16) * {FINAL1} % {_32} AS x FROM h2),
h4 AS (SELECT w, xor(x, x >> 13) * {FINAL2} % {_32} AS x FROM h3),
h5 AS (SELECT w, CAST(xor(x, x >> 16) AS BIGINT) AS x FROM h4),
hashed AS (SELECT w, CAST(((CASE WHEN x >= {_32 // 2} THEN x - {_32} ELSE x END) % {{n}} + {{n}}) % {{n}} AS INTEGER) AS bucket FROM h5)"""


@query("vectorize", f"""WITH x AS (SELECT doc_id AS Id, unnest({_sql_words(_CLEAN_DOC)}) AS w FROM documents),
{_sql_hash_ctes('x').format(n=NUM_FEATURES)},
tf AS (SELECT Id, bucket, count(*) AS tf FROM x JOIN hashed USING (w) GROUP BY ALL),
v AS (SELECT Id, '({NUM_FEATURES},[' || string_agg(CAST(bucket AS VARCHAR), ',' ORDER BY bucket) || '],['
        || string_agg(CAST(tf AS VARCHAR) || '.0', ',' ORDER BY bucket) || '])' AS features FROM tf GROUP BY Id)
SELECT doc_id AS Id, CASE WHEN lang = 'en' OR source = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       coalesce(features, '({NUM_FEATURES},[],[])') AS features
FROM documents LEFT JOIN v ON v.Id = doc_id""")
def vectorize(spark, sf):
    """X4/X6 ML form: (Id, label, features) with the Vector rendered as text."""
    d = fx.document_posts(spark, sf)
    d = X.clean_text(d, None, "Text", out="Clean").withColumn(
        "label", has_tag("Tags", "en"))
    v = X.vectorize(d, "Clean")
    return v.select("Id", "label", F.col("features").cast("string").alias("features"))
