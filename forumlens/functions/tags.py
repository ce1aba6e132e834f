"""Tag-string functions.  A post's tags arrive as one string ``<a><b><c>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens.constants import TAG_BRACKET_PATTERN, TAG_SEPARATOR_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_tags(tags) -> Column:
    """``<a><b>`` -> ``a b``: ``><`` becomes a space, then ``<``/``>`` go."""
    return F.regexp_replace(F.regexp_replace(_c(tags), TAG_SEPARATOR_PATTERN, " "),
                            TAG_BRACKET_PATTERN, "")


def tag_list(tags) -> Column:
    """Split the cleaned string on single spaces, as the reference does.

    Order and duplicates are kept; an empty tag string gives ``[""]``.
    """
    return F.split(clean_tags(tags), " ")


def tag_array(tags) -> Column:
    """Exact tag list: every ``<name>`` group; an empty string gives ``[]``."""
    return F.regexp_extract_all(_c(tags), F.lit(r"<([^<>]+)>"), 1)


def mentions_tag(tags, tag: str | Column) -> Column:
    """1.0 when the raw tag string *contains* ``tag`` as a substring, else 0.0.

    This is the label rule as written: tag ``r`` matches ``<rust>``.
    """
    t = F.lit(tag) if isinstance(tag, str) else tag
    return F.coalesce(_c(tags).contains(t), F.lit(False)).cast("double")


def has_tag(tags, tag: str | Column) -> Column:
    """1.0 when ``tag`` is one of the post's tags exactly, else 0.0."""
    t = F.lit(tag) if isinstance(tag, str) else tag
    return F.coalesce(F.array_contains(tag_array(tags), t),
                      F.lit(False)).cast("double")
