"""XML, JSON, CSV and text sources.

File readers use Spark's built-in data sources with explicit schemas; the
``*_lines`` variants parse a string column holding the same records (the
per-row parse of S3), so data already in a table can take the same path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.constants import USER_TAG_CSV, POSTS_WRAPPER, XML_PROLOG_PREFIX
from forumlens.schemas import (JSON_POSTS, POST_FIELDS, RAW_POSTS, RAW_TAGS,
                               TAG_FIELDS, USER_TAG)

_XML_OPTS = {"attributePrefix": "", "mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}


# ---- XML -------------------------------------------------------------------

def _xml_escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    c = F.replace(c, F.lit('"'), F.lit("&quot;"))
    for char, ref in (("\t", "&#x9;"), ("\n", "&#xA;"), ("\r", "&#xD;")):
        c = F.replace(c, F.lit(char), F.lit(ref))
    return c


def xml_row_line(columns: list[str]) -> Column:
    """``<row A="v" .../>`` for the given columns; null columns are omitted
    (an absent attribute), values entity-escaped."""
    attrs = [F.when(F.col(c).isNotNull(), F.concat(
        F.lit(f' {c}="'), _xml_escape(F.col(c).cast("string")), F.lit('"')))
        for c in columns]
    return F.concat(F.lit("<row"), F.concat_ws("", *attrs), F.lit(" />"))


def raw_defaults(df: DataFrame, fields: list[str]) -> DataFrame:
    """An absent attribute reads as ``""``, never null (reference parity)."""
    return df.select(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields])


def read_posts_xml(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """A Stack-Exchange ``Posts.xml`` (``<posts>`` of ``<row .../>``).

    Prolog, wrapper element, BOM and entities are handled by the reader.
    ``mode="PERMISSIVE"`` turns a malformed row into nulls instead of failing.
    """
    df = (spark.read.format("xml").option("rowTag", "row")
          .option("attributePrefix", "").option("mode", mode)
          .option("ignoreSurroundingSpaces", "false")
          .schema(RAW_POSTS).load(path))
    return raw_defaults(df, POST_FIELDS)


def read_tags_xml(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """A ``Tags.xml`` -> raw ``(Id, TagName, Count)`` strings."""
    df = (spark.read.format("xml").option("rowTag", "row")
          .option("attributePrefix", "").option("mode", mode)
          .option("ignoreSurroundingSpaces", "false")
          .schema(RAW_TAGS).load(path))
    return raw_defaults(df, TAG_FIELDS)


def parse_posts_xml_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """S3: one ``<row .../>`` per string -> raw posts columns."""
    parsed = df.select(F.from_xml(F.col(col), RAW_POSTS, _XML_OPTS).alias("r"))
    return raw_defaults(parsed.select("r.*"), POST_FIELDS)


def parse_tags_xml_lines(df: DataFrame, col: str = "value") -> DataFrame:
    parsed = df.select(F.from_xml(F.col(col), RAW_TAGS, _XML_OPTS).alias("r"))
    return raw_defaults(parsed.select("r.*"), TAG_FIELDS)


def _to_long(c: str) -> Column:
    return F.expr(f"try_cast(nullif({c}, '') AS BIGINT)")


def typed_posts(raw: DataFrame) -> DataFrame:
    """Raw string posts -> POSTS types; ``""`` and non-numbers become null
    (so an empty ParentId never joins an empty Id)."""
    return raw.select(
        _to_long("Id").alias("Id"),
        F.expr("try_cast(nullif(PostTypeId, '') AS INT)").alias("PostTypeId"),
        _to_long("ParentId").alias("ParentId"),
        F.col("Tags"), F.col("Title"), F.col("Body"),
        F.expr("try_cast(nullif(Score, '') AS DOUBLE)").alias("Score"),
        _to_long("OwnerUserId").alias("OwnerUserId"))


def typed_tags(raw: DataFrame) -> DataFrame:
    return raw.select(_to_long("Id").alias("Id"), F.col("TagName"),
                      _to_long("Count").alias("Count"))


def filter_wrapper_lines(df: DataFrame, col: str, wrapper: str = POSTS_WRAPPER) -> DataFrame:
    """Drop the XML prolog and the wrapper element lines of a text dump
    (needed only on a raw-text path; the XML reader does it itself)."""
    c = F.col(col)
    return df.where(~c.startswith(XML_PROLOG_PREFIX) & ~c.startswith("﻿" + XML_PROLOG_PREFIX)
                    & (c != f"<{wrapper}>") & (c != f"</{wrapper}>"))


# ---- JSON ------------------------------------------------------------------

def read_posts_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the post nested in ``row`` (explicit schema)."""
    return spark.read.schema(JSON_POSTS).json(path)


def parse_posts_json_lines(df: DataFrame, col: str = "value") -> DataFrame:
    return df.select(F.from_json(F.col(col), JSON_POSTS).alias("j")).select("j.*")


def json_questions(rows: DataFrame) -> DataFrame:
    """Questions that have tags, fields taken from the nested row."""
    r = F.col("row")
    return (rows.where(r["Tags"].isNotNull()
                       & (F.expr("try_cast(row.PostTypeId AS INT)") == 1))
            .select(*[r[f].alias(f) for f in ["Id", "OwnerUserId", "Tags",
                                              "AcceptedAnswerId", "Body",
                                              "AnswerCount"]]))


def json_answers(rows: DataFrame) -> DataFrame:
    r = F.col("row")
    return (rows.where(F.expr("try_cast(row.PostTypeId AS INT)") == 2)
            .select(*[r[f].alias(f) for f in ["Id", "OwnerUserId", "ParentId",
                                              "Score", "Body", "FavoriteCount"]]))


def json_qa_join(qs: DataFrame, ans: DataFrame, sort: bool = True) -> DataFrame:
    """Answers joined to their tagged question:
    ``(ParentId, OwnerUserId, Score, Tags)``."""
    q = qs.select(F.col("Id").alias("_qid"), F.col("Tags"))
    out = (ans.join(q, F.col("ParentId") == F.col("_qid"))
           .select("ParentId", "OwnerUserId", "Score", "Tags"))
    # tie-breakers let range partitioning split a hot ParentId
    return out.orderBy("ParentId", "OwnerUserId", "Score") if sort else out


# ---- CSV and text ----------------------------------------------------------

def read_user_tag_csv(spark: SparkSession, path: str) -> DataFrame:
    """``user,tag,score`` lines without header, as strings, in the dialect
    of ``write_user_tag_csv``."""
    return spark.read.schema(USER_TAG).options(**USER_TAG_CSV).csv(path)


def typed_user_tag(df: DataFrame) -> DataFrame:
    return df.select(_to_long("UserId").alias("UserId"), F.col("TagId"),
                     F.expr("try_cast(nullif(Score, '') AS DOUBLE)").alias("TotalScore"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> ``(word)``, trimmed, without empty lines; for
    ``text.remove_stop_words_table``."""
    return spark.read.text(path).select(java_trim_col("value").alias("word")).where(F.col("word") != "")


def java_trim_col(c: str) -> Column:
    from forumlens.functions.text import java_trim
    return java_trim(c)


def parse_basket_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """Space-separated items per line -> ``items array<string>``
    (other columns kept)."""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.split(java_trim_col(col), " ").alias("items"))


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    return parse_basket_lines(spark.read.text(path))


def basket_line(items: str = "items") -> Column:
    """One basket as a line of ``read_baskets``."""
    return F.array_join(items, " ")


def parse_multilabel_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """``l1,l2#f1 f2 f3`` -> ``(labels array<double>, features array<double>)``
    (other columns kept)."""
    parts = F.split(F.col(col), "#")
    keep = [c for c in df.columns if c != col]
    return df.select(*keep,
        F.transform(F.split(parts[0], ","), lambda x: x.cast("double")).alias("labels"),
        F.transform(F.split(parts[1], " "), lambda x: x.cast("double")).alias("features"))


def read_multilabel_vectors(spark: SparkSession, path: str) -> DataFrame:
    return parse_multilabel_lines(spark.read.text(path))
