"""Report filters: which rows of which mart the slicers leave.

Marts are unrelated, so a slicer on one mart's column reaches that mart's
results and no others.  Measures and top-n reports obey the filters; a share's
whole replaces some of them: all of the mart's, or the one on a named column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.functions.money import safe_divide
from tradeloom.plans import measures as M
from tradeloom.plans.marts import TOTAL


@dataclass(frozen=True)
class Filters:
    """Allowed values by mart and column; a column without an entry is free, one with an empty entry keeps nothing."""

    allowed: dict[str, dict[str, tuple]] = field(default_factory=dict)

    def select(self, mart: str, column: str, *values) -> Filters:
        """These filters, with those on one column replaced by a choice of values."""
        return Filters(self.allowed | {mart: self.allowed.get(mart, {}) | {column: values}})

    def free(self, mart: str, *columns: str) -> Filters:
        """These filters without those on the columns, or without any on the mart if none is named."""
        left = {c: v for c, v in self.allowed.get(mart, {}).items() if columns and c not in columns}
        return Filters(self.allowed | {mart: left})

    def predicate(self, mart: str, column: Callable[[str], Column] = F.col) -> Column:
        """Whether a row of the mart is left; null is a value like others."""
        kept = F.lit(True)
        for name, values in self.allowed.get(mart, {}).items():
            chosen = [column(name).eqNullSafe(F.lit(v)) for v in values]
            kept = kept & reduce(lambda a, b: a | b, chosen, F.lit(False))
        return kept

    def rows(self, mart: str, frame: DataFrame) -> DataFrame:
        return frame.where(self.predicate(mart))


def filtered(filters: Filters, mart: str, frame: DataFrame, measures: M.Measures, by: Iterable[str] = ()) -> DataFrame:
    """Measures of a mart under its filters."""
    return M.summarise(filters.rows(mart, frame), measures, list(by))


def share(filters: Filters, mart: str, frame: DataFrame, by: str, value: str, name: str, freed: Iterable[str] = ()) -> DataFrame:
    """Filtered groups and their share of a whole that ignores the filters on the ``freed`` columns, or all of the mart's.

    One pass: groups are summed with and without the filters, and the whole is
    the sum over groups; ``by`` is a code set or an attribute of few values.
    """
    whole = filters.free(mart, *freed).predicate(mart)
    kept = filters.predicate(mart)
    sums = frame.groupBy(by).agg(
        F.sum(F.when(kept, F.col(value))).cast(TOTAL).alias(value),
        F.sum(F.when(whole, F.col(value))).cast(TOTAL).alias("_whole"),
        F.max(kept).alias("_kept"),
    )
    total = sums.agg(F.sum("_whole").cast(TOTAL)).scalar()
    return sums.where("_kept").select(by, value, safe_divide(F.col(value), total).alias(name))


def page(filters: Filters, visuals: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """One row per member of every visual (mart, its rows, column, figure): what a page shows under the filters."""
    parts = []
    for mart, frame, by, figure in visuals:
        rows = filtered(filters, mart, frame, {"total": M.money_total(figure)}, [by])
        parts.append(rows.select(F.lit(mart).alias("mart"), F.lit(by).alias("shown_by"), F.col(by).cast("string").alias("member"), "total"))
    return reduce(DataFrame.unionByName, parts)
