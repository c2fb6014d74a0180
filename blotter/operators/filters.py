"""Dashboard filters as typed ``Column`` predicates (no SQL text building).

``Filters.predicate()`` folds the inclusive date range, the tri-state violence
flag, the optional type list and the optional area into one Column. The date
range also yields a redundant ``year BETWEEN`` predicate: ``year`` is derived
from the same timestamp as ``occurrence_date``, so results are unchanged, but
on the year-partitioned fact it prunes whole partitions at planning time.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes


def _as_date(d: str | date) -> date:
    return d if isinstance(d, date) else date.fromisoformat(str(d))


def violence_predicate(choice: str) -> Column | None:
    """``All`` (or unknown text) -> no predicate; null flags match neither side."""
    if choice == codes.VIOLENCE_ONLY:
        return F.col("is_violent") == F.lit(True)
    if choice == codes.VIOLENCE_NONE:
        return F.col("is_violent") == F.lit(False)
    return None


def types_predicate(types: list[str] | tuple[str, ...] | None) -> Column | None:
    """Membership in the chosen descriptions; empty or all-blank lists mean no filter."""
    vals = [t for t in (types or []) if t]
    return F.col("crime_description").isin(*vals) if vals else None


#: descriptions that a filter lists as literals; a longer list is joined
MOST_LITERALS = 100


def in_types(fact: DataFrame, types: DataFrame | list[str] | tuple[str, ...],
             column: str = "crime_description") -> DataFrame:
    """Rows whose description is in a list or table (first column) of any length; null and
    empty entries are skipped, and without any entry nothing is filtered. A short list is
    a literal; anything else is a semi join, which the planner broadcasts or shuffles by its
    size, with a Bloom filter of the list at the fact's scan where that pays."""
    if not isinstance(types, DataFrame):
        vals = list(dict.fromkeys(t for t in types if t))
        if len(vals) <= MOST_LITERALS:
            return fact.where(F.col(column).isin(*vals)) if vals else fact
        types = fact.sparkSession.createDataFrame([(v,) for v in vals], "v string")
    listed = types.select(F.col(types.columns[0]).alias(column)).where(F.col(column) != "").distinct()
    if listed.isEmpty():
        return fact
    return fact.join(listed, column, "left_semi").select(*fact.columns)


@dataclass(frozen=True)
class Filters:
    date_from: str | date
    date_to: str | date
    violence: str = codes.VIOLENCE_ALL
    crime_types: tuple[str, ...] = field(default_factory=tuple)
    area_id: str | None = None

    def without_area(self) -> "Filters":
        return replace(self, area_id=None)

    def without_types(self) -> "Filters":
        return replace(self, crime_types=())

    @property
    def uses_fact(self) -> bool:
        """Any violence or type filter needs incident rows; else the daily mart suffices."""
        return self.violence != codes.VIOLENCE_ALL or bool([t for t in self.crime_types if t])

    def date_predicate(self, column: str = "occurrence_date", prune_year: bool = True) -> Column:
        d0, d1 = _as_date(self.date_from), _as_date(self.date_to)
        p = F.col(column).between(F.lit(d0), F.lit(d1))
        if prune_year:
            p = p & F.col("year").between(d0.year, d1.year)
        return p

    def predicate(self, prune_year: bool = True) -> Column:
        parts = [self.date_predicate(prune_year=prune_year),
                 violence_predicate(self.violence),
                 types_predicate(list(self.crime_types))]
        if self.area_id:
            parts.append(F.col("area_id") == F.lit(self.area_id))
        out = None
        for p in parts:
            if p is not None:
                out = p if out is None else out & p
        return out

    def apply(self, fact: DataFrame) -> DataFrame:
        """The fact's rows that pass; a long list of types is joined."""
        if len(self.crime_types) <= MOST_LITERALS:
            return fact.where(self.predicate())
        return in_types(fact.where(self.without_types().predicate()), self.crime_types)


def default_period(mart_or_fact: DataFrame, days: int = 365,
                   column: str = "occurrence_date") -> DataFrame:
    """Last ``days`` days of data, clipped at the first day: (date_from, date_to)."""
    b = mart_or_fact.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return b.select(F.greatest(F.col("lo"), F.date_sub(F.col("hi"), days)).alias("date_from"),
                    F.col("hi").alias("date_to"))
