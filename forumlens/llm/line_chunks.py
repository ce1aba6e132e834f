"""Operator 7, line dedup by content-defined chunks of lines (DataFrame and
SQL functions only).

A text is cut into lines at newlines.  A chunk ends after a line if the
rolling hash of the last two lines' hashes is less than that of the line before
and not more than that of the line after it (a local minimum, so two such
borders are two lines or more apart), and around every long line (a paragraph
of ``LONG`` spaces or more, over 50 words).  A border depends on four lines
only and moves along when lines are inserted before it.  Chunks of
``MIN_LINES`` lines or more, and long lines, that occur several times in the
corpus, in one document or in many, are kept at their first place (least
doc_id, then place in the text) and removed everywhere else.  A removed chunk
grows by the lines next to it that are also next to its first place, up to the
end of the neighbouring chunk; of a chunk that is the first place of a repeated
one, it takes all lines or none.  Lines beyond that, at the edge of a passage
whose outer chunks differ from text to text, stay.

Repeats are found by a 128-bit hash of each chunk (an aggregate that is
partial in every task, so a chunk that a third of all documents hold does
not gather in one), then compared byte by byte with their first place: a hash
whose chunks differ is resolved by the chunks' text (these do not grow).  What
is joined with all texts grows in proportion to them, so these joins are
sort-merge joins at every size; the places of one chunk are salted.

Defined results: a null text stays null, an empty one empty; a text whose
lines all go becomes empty; a repeated line that is not long stays unless it is
next to a repeated chunk in both places;
null doc_ids come last in the order of places; rows that repeat both doc_id
and text are one document and are edited alike; other columns are unchanged,
whatever their names.

A near copy would be cut to the lines in which it differs.
``without_copies`` therefore takes copies away whole, before ``dedup``: a
document that shares a repeated chunk with the document of the chunk's first
place, and has at least ``COPY`` of the word 5-grams of both in common with
it (by 64-bit hashes).  Copies of copies go with them; the first document of
such a chain stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import arrow_session, materialize
from forumlens.plans.sql import md5_int

MIN_LINES = 2                 # "multi-line"
LONG = 50                     # spaces of a line that is a chunk of its own
MODULUS, FACTOR = 1_000_003, 31   # of the rolling hash
SALTS = 16                    # tasks that share the places of a chunk
SHARE = 4096                  # texts of one chunk that a task compares
WORDS, COPY = 5, (4, 5)       # words of a shingle, Jaccard similarity of a copy
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _line_hash(x: Column) -> Column:
    return F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is computed once per row: a generator is a border
    that the optimizer does not move expressions across."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _is_long(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) >= LONG


def with_chunks(df: DataFrame, text: Column) -> DataFrame:
    """Add ``chunks`` array<struct<lines, chunk>>, null for a null text."""
    none = F.array(F.lit(-1).cast("long"))
    df = _once(df, F.split(text, "\n", -1), "_lines")
    df = _once(df, F.transform("_lines", _line_hash), "_hash")
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("_hash", 1, F.size("_hash") - 1))
    df = _once(df, F.zip_with(before, "_hash", lambda p, h: (p * FACTOR + h) % MODULUS), "_roll")
    df = _once(df, F.transform("_lines", _is_long), "_long")
    last = F.size("_roll") - 1
    cut = F.transform(F.arrays_zip(
        F.col("_roll").alias("r"), F.concat(none, F.slice("_roll", 1, last)).alias("p"),
        F.concat(F.slice("_roll", 2, last), none).alias("n"), F.col("_long").alias("long"),
        F.concat(F.slice("_long", 2, last), F.array(F.lit(False))).alias("then")),
        lambda x: ((x["r"] < x["p"]) & (x["r"] <= x["n"])) | x["long"] | x["then"])
    ends = F.filter(F.transform(cut, lambda c, i: F.when(c, i + 1)), lambda x: x.isNotNull())
    df = _once(df, F.array_distinct(F.concat(ends, F.array(F.size("_lines")))), "_ends")
    starts = F.concat(F.array(F.lit(0)), F.slice("_ends", 1, F.size("_ends") - 1))
    chunks = F.transform(
        F.arrays_zip(starts.alias("a"), F.col("_ends").alias("b")),
        lambda s: F.struct((s["b"] - s["a"]).alias("lines"),
                           F.array_join(F.slice("_lines", s["a"] + 1, s["b"] - s["a"]), "\n").alias("chunk")))
    return _once(df, chunks, "chunks").drop("_lines", "_hash", "_roll", "_long", "_ends")


def _keyed(docs: DataFrame, key: str, body: str) -> DataFrame:
    """Add the text, the place in order (d) and the name of the document."""
    return docs.select(
        "*", F.col(body).alias("text"),
        F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("d"),
        F.xxhash64(F.lit(1), key, body).alias("r1"), F.xxhash64(F.lit(2), key, body).alias("r2"))


def _places(texts: DataFrame) -> DataFrame:
    """(d, r1, r2, pos, c1, c2) of every chunk of several lines or a long one."""
    hashed = F.transform("chunks", lambda c, i: F.when(
        (c["lines"] >= MIN_LINES) | _is_long(c["chunk"]),
        F.struct(i.alias("pos"), F.xxhash64(F.lit(1), c["chunk"]).alias("c1"),
                 F.xxhash64(F.lit(2), c["chunk"]).alias("c2"))))
    places = with_chunks(texts, F.col("text")).select(
        "d", "r1", "r2", F.inline(F.filter(hashed, lambda c: c.isNotNull())))
    return materialize(places, "chunks")


def _salted(places: DataFrame, again: DataFrame) -> DataFrame:
    """``places`` of the chunks in ``again``; the places of one chunk go to
    ``SALTS`` tasks."""
    left = places.withColumn("_salt", F.pmod(F.xxhash64("r1", "pos"), F.lit(SALTS)))
    right = again.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, ["c1", "c2", "_salt"]).drop("_salt")


def _again(places: DataFrame) -> DataFrame:
    """(c1, c2, n, first): the first place of each chunk that occurs again."""
    return (places.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("d", "r1", "r2", "pos")).alias("first"))
            .where("n > 1"))


def _common(a: Column, b: Column, all_or_none: Column, last: bool = False) -> Column:
    """Number of lines of ``a`` that ``b`` has too at its start, or at its end."""
    a, b = F.split(a, "\n", -1), F.split(b, "\n", -1)
    if last:
        a, b = F.reverse(a), F.reverse(b)
    other = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    n = F.when(other > 0, other - 1).when(other == 0, F.size(a))
    return F.coalesce(F.when(~all_or_none | (n == F.size(a)), n), F.lit(0)).cast("int")


def _compared(repeats: DataFrame) -> DataFrame:
    """(c1, c2, r1, r2, pos, same, up, down) of the later places in ``repeats``:
    whether their bytes equal those of the first one, and by how many lines
    they grow.  The later places of one chunk go to tasks by ``SHARE``."""
    parts = F.ceil(F.col("n") / SHARE).cast("long")
    first = repeats.where("not extra").select(
        "c1", "c2", F.col("chunk").alias("fchunk"), F.col("prev").alias("fprev"), F.col("next").alias("fnext"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_salt"))
    later = repeats.where("extra").withColumn("_salt", F.pmod(F.xxhash64("r1", "pos"), parts))
    return later.join(first.hint("merge"), ["c1", "c2", "_salt"]).select(
        "c1", "c2", "r1", "r2", "pos", (F.col("chunk") == F.col("fchunk")).alias("same"),
        _common(F.col("prev"), F.col("fprev"), F.col("prev_first"), True).alias("up"),
        _common(F.col("next"), F.col("fnext"), F.col("next_first")).alias("down"))


def _with_shingles(df: DataFrame, text: Column) -> DataFrame:
    """Add ``s``: distinct hashes of the word 5-grams (of all words, if fewer)."""
    words = F.filter(F.split(F.translate(text, UPPER, LOWER), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    at = F.sequence(F.lit(1), F.greatest(F.size("_words") - (WORDS - 1), F.lit(1)))
    shingles = F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.slice("_words", i, WORDS))))
    return _once(_once(df, words, "_words"), shingles, "s").drop("_words")


def without_copies(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are no near copy of an earlier one with which they
    share a chunk; columns unchanged."""
    arrow_session(documents)
    names = documents.columns
    docs = documents.toDF(*(f"_c{i}" for i in range(len(names))))
    docs = _keyed(docs, f"_c{names.index(doc_id)}", f"_c{names.index(text)}")
    texts = docs.select("text", "d", "r1", "r2")
    places = _places(texts)
    pairs = _salted(places, _again(places)).select(
        "r1", "r2", F.col("first.r1").alias("f1"), F.col("first.r2").alias("f2"))
    pairs = materialize(pairs.where("r1 <> f1 or r2 <> f2").distinct(), "pairs")
    some = pairs.select("r1", "r2").union(pairs.select("f1", "f2")).distinct()
    sets = _with_shingles(texts.join(some.hint("merge"), ["r1", "r2"]).dropDuplicates(["r1", "r2"]), F.col("text"))
    sets = materialize(sets.select("r1", "r2", "s", F.size("s").alias("n")), "shingles")
    # sizes first: a pair that can be a copy has two sets of about one size
    sizes = sets.select("r1", "r2", "n")
    other = sizes.toDF("f1", "f2", "fn")
    p, q = COPY
    pairs = materialize(pairs.join(sizes, ["r1", "r2"]).join(other, ["f1", "f2"])
                        .where(q * F.least("n", "fn") >= p * F.greatest("n", "fn")), "near")
    both = pairs.join(sets.drop("n"), ["r1", "r2"]).join(
        sets.select(F.col("r1").alias("f1"), F.col("r2").alias("f2"), F.col("s").alias("fs")), ["f1", "f2"])
    both = both.select("r1", "r2", "n", "fn", F.size(F.array_intersect("s", "fs")).alias("i"))
    copies = both.where(q * F.col("i") >= p * (F.col("n") + F.col("fn") - F.col("i"))).select("r1", "r2").distinct()
    left = docs.join(materialize(copies, "copies").hint("merge"), ["r1", "r2"], "left_anti")
    return left.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))


def dedup(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, chunks_removed, lines_removed): ``row`` holds the document's
    columns with the repeated chunks gone from ``text``."""
    arrow_session(documents)
    names = documents.columns                # numbered meanwhile: none can clash
    docs = documents.toDF(*(f"_c{i}" for i in range(len(names))))
    key, body = f"_c{names.index(doc_id)}", f"_c{names.index(text)}"
    docs = _keyed(docs, key, body)

    def row(new_text: Column) -> Column:
        return F.struct(*((new_text if c == text else F.col(f"_c{i}")).alias(c)
                          for i, c in enumerate(names))).alias("row")

    texts = docs.select("text", "d", "r1", "r2")
    places = _places(texts)
    place = F.struct("d", "r1", "r2", "pos")
    found = materialize(_salted(places, _again(places))
                        .withColumn("extra", place != F.col("first")).drop("first"), "repeats")
    # byte comparison of all repeats with their first places; a neighbour that
    # goes itself is not carried along
    at = found.groupBy("r1", "r2").agg(F.collect_set(F.struct("pos", "c1", "c2", "n", "extra")).alias("at"))
    whole = with_chunks(texts.join(at.hint("merge"), ["r1", "r2"]), F.col("text"))

    def beside(x, step, name):
        here = F.filter("at", lambda y: y["pos"] == x["pos"] + step)
        chunk = F.get("chunks", x["pos"] + step)["chunk"]
        return (F.when(~x["extra"] | ~F.exists(here, lambda y: y["extra"]), chunk).alias(name),
                (F.size(here) > 0).alias(f"{name}_first"))

    repeats = materialize(whole.select("d", "r1", "r2", F.inline(F.transform("at", lambda x: F.struct(
        x["pos"].alias("pos"), x["c1"].alias("c1"), x["c2"].alias("c2"), x["n"].alias("n"), x["extra"].alias("extra"),
        F.get("chunks", x["pos"])["chunk"].alias("chunk"), *beside(x, -1, "prev"), *beside(x, 1, "next"))))),
        "texts")
    extra = materialize(_compared(repeats), "later")
    differ = materialize(extra.where("not same").select("c1", "c2").distinct(), "differ")
    extra = extra.drop("same")
    if differ.head(1):                       # chunks of one hash that are not equal
        odd = repeats.join(differ, ["c1", "c2"])
        first = odd.groupBy("chunk").agg(F.min(place).alias("first"))
        odd = odd.join(first, "chunk").where(place != F.col("first")).select(
            "c1", "c2", "r1", "r2", "pos", F.lit(0).alias("up"), F.lit(0).alias("down"))
        extra = extra.join(differ, ["c1", "c2"], "left_anti").unionByName(odd)
    drop = extra.groupBy("r1", "r2").agg(F.collect_set(F.struct("pos", "up", "down")).alias("drop"))
    # one shuffle of the texts; only texts with something to remove are cut
    rows = docs.drop("d", "text").join(drop.hint("merge"), ["r1", "r2"], "left")
    rows = with_chunks(rows, F.when(F.col("drop").isNotNull(), F.col(body)))

    def grown(i, name):                      # lines that the repeat at place i takes beside it
        return F.coalesce(F.array_max(F.transform(F.filter("drop", lambda x: x["pos"] == i), lambda x: x[name])), F.lit(0))

    def rest(c, i):
        head, tail = grown(i - 1, "down"), grown(i + 1, "up")
        left = F.when(F.array_contains(F.col("drop.pos"), i), 0).otherwise(c["lines"] - head - tail)
        return F.struct(left.alias("lines"), F.when(left == c["lines"], c["chunk"]).when(left > 0, F.array_join(
            F.slice(F.split(c["chunk"], "\n", -1), head + 1, F.greatest(left, F.lit(0))), "\n")).alias("chunk"))

    rows = _once(rows, F.filter(F.transform("chunks", rest), lambda c: c["lines"] > 0), "_kept")
    size = F.aggregate("chunks", F.lit(0).cast("long"), lambda s, c: s + c["lines"])
    left = F.aggregate("_kept", F.lit(0).cast("long"), lambda s, c: s + c["lines"])
    edited = F.array_join(F.transform("_kept", lambda c: c["chunk"]), "\n")
    return rows.select(
        row(F.when(F.col("drop").isNull(), F.col(body)).otherwise(edited)),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("chunks_removed"),
        F.coalesce(size - left, F.lit(0).cast("long")).alias("lines_removed"))


ORACLE = f"""
WITH x AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, {md5_int('line')} AS h FROM x),
l AS (SELECT *, (coalesce(lag(h) OVER w, 0) * {FACTOR} + h) % {MODULUS} AS r,
             length(line) - length(replace(line, ' ', '')) >= {LONG} AS long
      FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
c AS (SELECT *, coalesce(r < lag(r) OVER w AND r <= lead(r) OVER w, false) OR long
             OR coalesce(lead(long) OVER w, false) AS cut
      FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT *, coalesce(sum(CAST(cut AS INTEGER)) OVER (
        PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
      FROM c),
k AS (SELECT doc_id, chunk, list(line ORDER BY pos) AS ls, count(*) >= {MIN_LINES} OR bool_or(long) AS counts
      FROM g GROUP BY doc_id, chunk),
r AS (SELECT *, counts AND row_number() OVER s > 1 AS gone,
             counts AND count(*) OVER (PARTITION BY counts, ls) > 1 AS again,
             lag(ls) OVER d AS up, lead(ls) OVER d AS down
      FROM k WINDOW s AS (PARTITION BY counts, ls ORDER BY doc_id, chunk), d AS (PARTITION BY doc_id ORDER BY chunk)),
f AS (SELECT *, first_value(up) OVER s AS fup, first_value(down) OVER s AS fdown
      FROM r WINDOW s AS (PARTITION BY counts, ls ORDER BY doc_id, chunk)),
e AS (SELECT *, CASE WHEN gone THEN len(list_filter(range(1, least(len(up), len(fup)) + 1),
                  lambda i: list_reverse(up)[1:i] = list_reverse(fup)[1:i])) END AS grow_up,
             CASE WHEN gone THEN len(list_filter(range(1, least(len(down), len(fdown)) + 1),
                  lambda i: down[1:i] = fdown[1:i])) END AS grow_down
      FROM f),
n AS (SELECT *, coalesce(lag(grow_down) OVER d, 0) AS below, coalesce(lead(grow_up) OVER d, 0) AS above
      FROM e WINDOW d AS (PARTITION BY doc_id ORDER BY chunk)),
t AS (SELECT *, CASE WHEN again AND below < len(ls) THEN 0 ELSE below END AS head,
             CASE WHEN again AND above < len(ls) THEN 0 ELSE above END AS tail
      FROM n),
o AS (SELECT doc_id,
             array_to_string(flatten(list(CASE WHEN gone OR head + tail >= len(ls) THEN []
                                          ELSE ls[1 + head:len(ls) - tail] END ORDER BY chunk)), chr(10)) AS text,
             CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS chunks_removed,
             CAST(sum(CASE WHEN gone THEN len(ls) ELSE least(len(ls), head + tail) END) AS BIGINT) AS lines_removed
      FROM t GROUP BY doc_id)
SELECT d.doc_id, o.text, coalesce(o.chunks_removed, 0) AS chunks_removed,
       coalesce(o.lines_removed, 0) AS lines_removed
FROM documents d LEFT JOIN o USING (doc_id)"""
