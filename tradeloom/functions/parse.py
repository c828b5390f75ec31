"""Tolerant parsing: anything unparseable becomes NULL, never an error.

The session runs in ANSI mode, so every conversion of a source value goes
through ``try_cast`` / ``try_to_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted spellings.
PLAIN_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"
ISO_DATE_PATTERN = (
    r"^[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}"
    r"([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?)?)?$"
)
NUMERIC_DATE_PATTERN = r"^[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}$"
NAMED_DATE_PATTERN = r"[A-Za-z]{3}"
SHORT_YEAR_PATTERN = r"^[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2}$"
YEAR_MONTH_PATTERN = r"^[0-9]{4}[-/.][0-9]{1,2}$"
CLOCK_PATTERN = (
    r"(?i)[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?( ?[AP]M)?( ?(Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2}))?$"
)
WEEKDAY_PATTERN = r"(?i)^(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?[,.]? "
NUMERIC_DATE_FORMATS = ("M-d-yyyy", "d-M-yyyy", "yyyy-M-d")
SHORT_YEAR_FORMATS = ("M-d-yy", "d-M-yy")
NAMED_DATE_FORMATS = (
    "MMM d yyyy", "d MMM yyyy", "MMMM d yyyy", "d MMMM yyyy", "yyyy MMM d", "MMM yyyy", "MMMM yyyy"
)
# Two-digit years from this one on are of the last century.
LAST_CENTURY = 2069


def parse_numeric(c: Column) -> Column:
    """Text to double.

    The guard rejects what Java's parser would let through (``1d``, ``0x1p3``,
    ``nan``); infinities are kept because they are numbers to the contract.
    """
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    infinity = F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double")).when(
        t.rlike(INFINITY_PATTERN), infinity
    )


def parse_decimal(c: Column) -> Column:
    """Text to ``decimal(38,18)``: exact to 18 places, NULL for anything that is no finite decimal number.

    The one parser of the rules and of the load, so no rule sees a NaN or an
    infinity.  Blanks around a number, a sign and an exponent are accepted.
    """
    return c.try_cast("decimal(38,18)")


def parse_date(c: Column) -> Column:
    """Text to date, each value by its own format, month first when ambiguous.

    The branches are ordered from the common spelling to the rare one and each
    is guarded, so a well-formed ISO value costs one match and one cast.  All
    others go through a lambda, whose body is not compiled into the caller's
    stage: with it the stage's method outgrows what the JVM compiles.
    A weekday in front and a clock time behind are ignored; a month stands for
    its first day.  Relative words (``now``, ``today``) and clock-only values
    are not dates here.
    """
    plain = F.when(c.rlike(PLAIN_DATE_PATTERN), c.try_cast("date"))
    return F.coalesce(plain, F.get(F.transform(F.array(c), _other_date), F.lit(0)))


def _other_date(c: Column) -> Column:
    """The date of a text that is not spelled ``yyyy-MM-dd``."""
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    iso = F.when(t.rlike(ISO_DATE_PATTERN), t.try_cast("date"))
    compact = F.when(t.rlike(r"^[0-9]{8}([0-9]{6})?$"), F.try_to_date(F.substring(t, 1, 8), "yyyyMMdd"))
    day = F.regexp_replace(F.regexp_replace(t, WEEKDAY_PATTERN, ""), CLOCK_PATTERN, "")
    dashed = F.regexp_replace(day, r"[/.]", "-")
    named = F.initcap(F.trim(F.regexp_replace(day, r"[-,/. ]+", " ")))
    named = F.regexp_replace(named, r"\bSept\b", "Sep")
    short = F.coalesce(*[F.try_to_date(dashed, f) for f in SHORT_YEAR_FORMATS])
    short = F.when(F.year(short) >= LAST_CENTURY, F.add_months(short, -1200)).otherwise(short)
    numeric = (
        F.when(day.rlike(SHORT_YEAR_PATTERN), short)
        .when(day.rlike(YEAR_MONTH_PATTERN), F.try_to_date(F.concat(dashed, F.lit("-1")), "yyyy-M-d"))
        .when(
            day.rlike(NUMERIC_DATE_PATTERN),
            F.coalesce(*[F.try_to_date(dashed, f) for f in NUMERIC_DATE_FORMATS]),
        )
    )
    by_name = F.when(
        day.rlike(NAMED_DATE_PATTERN),
        F.coalesce(*[F.try_to_date(named, f) for f in NAMED_DATE_FORMATS]),
    )
    return F.coalesce(iso, compact, numeric, by_name)
