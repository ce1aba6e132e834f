"""Text cleaning and tokenizing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens.constants import MARKUP_PATTERN, NON_WORD_PATTERN

# Java's \s: space, tab, newline, vertical tab, form feed, carriage return.
WS = r"[ \t\n\x0B\f\r]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(s) -> Column:
    """Trim every char <= U+0020 from both ends (Java ``String.trim``)."""
    return F.regexp_replace(F.regexp_replace(_c(s), r"^[\x00-\x20]+", ""),
                            r"[\x00-\x20]+$", "")


def strip_markup(body) -> Column:
    """Replace each greedy, whitespace-free ``<...>`` run by one space."""
    return F.regexp_replace(_c(body), MARKUP_PATTERN, " ")


def post_text(title, body) -> Column:
    """Title + " " + plain body; newlines -> space; space runs -> one space;
    then every non-word char -> space (in this order, so new runs appear).

    The last three steps are one regex pass: ``[ \\n]+`` (a run of spaces and
    newlines, which the first two steps turn into one space) or else one
    ``\\W`` char, each replaced by a space.  The markup pass stays separate:
    its inserted spaces take part in the run collapsing.
    """
    text = F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "),
                    strip_markup(F.coalesce(_c(body), F.lit(""))))
    return F.regexp_replace(text, "[ \n]+|" + NON_WORD_PATTERN, " ")


def tokenize_expr(text, keep_empty: bool = False) -> Column:
    """Lower-case and split on every single whitespace char.

    ``keep_empty=True`` reproduces the ML ``Tokenizer`` exactly: inner empty
    tokens stay, trailing ones go, an all-whitespace string gives ``[]``.
    The default drops every empty token.
    """
    low = F.lower(_c(text))
    if not keep_empty:
        return F.filter(F.split(low, WS), lambda w: w != F.lit(""))
    stripped = F.regexp_replace(low, WS + "+$", "")
    return (F.when(low.rlike("^" + WS + "+$"), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, WS)))
