"""Text clean-up used by every source column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Text in which there is nothing to collapse or strip: printable ASCII without blanks, matched in one pass from the start.
TIDY_PATTERN = r"^[!-~]*\z"


def norm_text(c: Column) -> Column:
    """Collapse whitespace runs to one blank and strip both ends.

    The regex runs first because Spark's ``trim`` only removes U+0020; tabs,
    newlines and non-breaking blanks become plain blanks and are trimmed after.
    Text of printable ASCII without blanks, as ids and codes are, needs neither.
    """
    t = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(t.rlike(TIDY_PATTERN), t).otherwise(collapse_blanks(t))


def collapse_blanks(t: Column) -> Column:
    """Every run of whitespace of any kind as one blank, none at the ends."""
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def norm_code(c: Column) -> Column:
    """``norm_text`` in upper case."""
    return F.upper(norm_text(c))


def is_blank(c: Column) -> Column:
    """True for NULL and for text that holds nothing but whitespace."""
    return c.isNull() | (norm_text(c) == "")
