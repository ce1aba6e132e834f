"""Post selections and the question-answer self-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUESTION, ANSWER = 1, 2


def questions(posts: DataFrame, kind: str = "PostTypeId") -> DataFrame:
    return posts.where(F.col(kind) == QUESTION)


def answers(posts: DataFrame, kind: str = "PostTypeId") -> DataFrame:
    return posts.where(F.col(kind) == ANSWER)


def _parents(posts: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    cols = [F.col("Id").alias("_parent_id"), F.col("Tags").alias("_parent_tags")]
    cols += [F.col(c).alias(f"_parent_{c}") for c in extra]
    return posts.select(*cols)


def qa_join(posts: DataFrame, sort: bool = False) -> DataFrame:
    """Every post that has a parent, with its owner and score and the
    parent's tags: ``(ParentId, Id, OwnerUserId, Score, Tags)``.

    Both sides are large, so this is a shuffled equi-join on the thread key;
    a hot question (one parent with a large share of all answers) is split
    by AQE's skew-join handling, the parent row being replicated to each
    split.  ``sort=True`` adds the reference's global order by ParentId.
    """
    child = posts.where(F.col("ParentId").isNotNull()).select(
        "ParentId", "Id", "OwnerUserId", "Score")
    out = (child.join(_parents(posts), F.col("ParentId") == F.col("_parent_id"))
           .select("ParentId", "Id", "OwnerUserId", "Score",
                   F.col("_parent_tags").alias("Tags")))
    # ParentId order with tie-breakers: range bounds can then fall inside a
    # hot ParentId, so one question's answers are sorted by several tasks
    return out.orderBy("ParentId", "OwnerUserId", "Score", "Id") if sort else out


def answers_inherit_tags(posts: DataFrame, *text: str) -> DataFrame:
    """Answers carry their question's tags.

    ``(Id, PostTypeId, ParentId, Tags, OwnerUserId, Score, *text)`` with the
    answer's own columns but the parent's tags; ``text`` names the text
    columns to keep (Title, Body).
    """
    a = answers(posts).select("Id", "PostTypeId", "ParentId", "OwnerUserId", "Score", *text)
    out = a.join(_parents(posts), F.col("ParentId") == F.col("_parent_id"))
    return out.select("Id", "PostTypeId", "ParentId", F.col("_parent_tags").alias("Tags"),
                      "OwnerUserId", "Score", *text)


def training_set(posts: DataFrame, *text: str) -> DataFrame:
    """Questions unioned with answers that inherit their question's tags,
    with the ``text`` columns (Title, Body) of each post."""
    cols = ["Id", "PostTypeId", "ParentId", "Tags", "OwnerUserId", "Score", *text]
    return questions(posts).select(*cols).unionByName(answers_inherit_tags(posts, *text).select(*cols))


def any_column_contains(df: DataFrame, term: str) -> DataFrame:
    """Rows whose rendered row ``[v1,v2,...]`` contains ``term``.

    Nulls render as ``null`` like a printed Row.  Returns the filtered rows;
    count them with ``.count()`` or an aggregate.
    """
    rendered = F.concat(F.lit("["), F.concat_ws(",", *[
        F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]),
        F.lit("]"))
    return df.where(rendered.contains(term))
