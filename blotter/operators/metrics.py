"""Filterable dashboard metrics over the gold fact and the daily mart.

Every function returns a DataFrame; callers collect only the (small) result.
Top-k uses ``orderBy(...).limit(k)`` – planned as ``TakeOrderedAndProject``:
each task keeps its own k best rows and only those reach the final merge. Ties
on the measure are broken by the label so results never depend on task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import topk
from .filters import Filters
from .order import ordered


def _violent() -> Column:
    return F.sum(F.when(F.col("is_violent"), 1).otherwise(0))


def _top(df: DataFrame, measure: str, label: str, limit: int) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), F.col(label).asc_nulls_last()).limit(int(limit))


# Q01
def date_bounds(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("occurrence_date").alias("min_date"),
                    F.max("occurrence_date").alias("max_date"))


# Q02 – unweighted averages of the daily averages / medians (mart path)
def map_agg_mart(mart: DataFrame, date_from, date_to) -> DataFrame:
    f = Filters(date_from, date_to)
    return (mart.where(f.date_predicate(prune_year=False))
                .groupBy("area_id", "area_name")
                .agg(F.sum("crime_count").alias("crime_count"),
                     F.sum("violent_count").alias("violent_count"),
                     F.avg("avg_reporting_delay_days").alias("avg_reporting_delay_days"),
                     F.avg("median_reporting_delay_days").alias("median_reporting_delay_days"))
                .withColumn("violent_share", C.share("violent_count", "crime_count")))


# Q03
def top_types(fact: DataFrame, f: Filters, limit: int = 60) -> DataFrame:
    """Most frequent descriptions; no area and no type filter apply."""
    g = (fact.where(Filters(f.date_from, f.date_to, f.violence).predicate()
                    & F.col("crime_description").isNotNull())
             .groupBy("crime_description").agg(F.count(F.lit(1)).alias("incidents")))
    return _top(g, "incidents", "crime_description", limit)


def top_types_two_phase(fact: DataFrame, f: Filters, limit: int = 60, size: int = topk.SUMMARY) -> DataFrame:
    """As ``top_types``, for very many descriptions: only those that may be among the most
    frequent are counted through the shuffle."""
    return topk.top_counts(fact.where(Filters(f.date_from, f.date_to, f.violence).predicate()),
                           "crime_description", limit, size=size)


# Q04 – incident-weighted measures, approximate median (fact path)
def map_agg_fact(fact: DataFrame, f: Filters) -> DataFrame:
    return (f.without_area().apply(fact)
                .groupBy("area_id", "area_name")
                .agg(F.count(F.lit(1)).alias("crime_count"),
                     _violent().alias("violent_count"),
                     F.avg("reporting_delay_days").alias("avg_reporting_delay_days"),
                     F.percentile_approx("reporting_delay_days", 0.5)
                      .alias("median_reporting_delay_days"))
                .withColumn("violent_share", C.share("violent_count", "crime_count")))


# Q18 – mart when no incident-level filter is set, else the fact
def area_map(fact: DataFrame, mart: DataFrame, f: Filters) -> DataFrame:
    if f.uses_fact:
        return map_agg_fact(fact, f)
    return map_agg_mart(mart, f.date_from, f.date_to).select(
        "area_id", "area_name", "crime_count", "violent_count", "avg_reporting_delay_days",
        "median_reporting_delay_days", "violent_share")


# Q05
def area_daily_series(fact: DataFrame, f: Filters) -> DataFrame:
    daily = (f.apply(fact)
             .groupBy("occurrence_date")
             .agg(F.count(F.lit(1)).alias("crime_count"), _violent().alias("violent_count"))
             .withColumn("violent_share", C.share("violent_count", "crime_count")))
    return ordered(daily, "occurrence_date")


# Q06
def area_top_types(fact: DataFrame, f: Filters, limit: int = 12) -> DataFrame:
    g = (f.apply(fact).where(F.col("crime_description").isNotNull())
             .groupBy("crime_description")
             .agg(F.count(F.lit(1)).alias("incidents"), _violent().alias("violent_incidents")))
    return _top(g, "incidents", "crime_description", limit)


# Q07
def _monthly_by_type(fact: DataFrame, f: Filters) -> DataFrame:
    return (f.apply(fact).where(F.col("crime_description").isNotNull())
                .groupBy(C.month_start("occurrence_ts").alias("month_start"), "crime_description")
                .agg(F.count(F.lit(1)).alias("incidents"), _violent().alias("violent_incidents")))


def monthly_trend(fact: DataFrame, f: Filters) -> DataFrame:
    return _monthly_by_type(fact, f).orderBy("month_start", "crime_description")


# J08 – top-N types over all areas feed the per-type monthly series
def monthly_trend_topn(fact: DataFrame, f: Filters, n: int = 8) -> DataFrame:
    """The planner picks the join from the measured size of the top list."""
    top = top_types(fact, f.without_area(), limit=n).select("crime_description")
    picked = fact.join(top, "crime_description", "left_semi")
    return monthly_trend(picked, f.without_types())


# Q08
def weekday_hour(fact: DataFrame, f: Filters) -> DataFrame:
    return (f.apply(fact)
                .groupBy("weekday", "hour_occ")
                .agg(F.count(F.lit(1)).alias("incidents")))


# Q19 – weekday x hour matrix (hours 0..23 as columns, missing cells 0)
def weekday_hour_matrix(fact: DataFrame, f: Filters) -> DataFrame:
    """The weekday x hour counts pivoted wide, as one conditional aggregation per
    weekday (one shuffle; no distinct-values job). ``h_other`` counts the incidents of
    any other hour, null included, so every incident is in one cell."""
    hour = F.col("hour_occ")
    wide = (f.apply(fact)
                .groupBy("weekday")
                .agg(*[F.count_if(hour == F.lit(h)).alias(f"h{h:02d}") for h in range(24)],
                     F.count_if(~F.coalesce(hour.between(0, 23), F.lit(False))).alias("h_other")))
    return ordered(wide, C.weekday_order("weekday"), F.col("weekday").asc_nulls_last())


# Q09
def area_list(mart: DataFrame) -> DataFrame:
    named = mart.where(F.col("area_id").isNotNull() & F.col("area_name").isNotNull())
    return ordered(named.select("area_id", "area_name").distinct(), "area_name", "area_id")


# J07 – area name -> id (first id in id order)
def area_id_for_name(areas: DataFrame, area_name: str) -> DataFrame:
    return (areas.where(F.col("area_name") == F.lit(area_name))
                 .agg(F.min("area_id").alias("area_id")))


# Q10
def _monthly(fact: DataFrame, f: Filters) -> DataFrame:
    return (f.apply(fact)
                .groupBy(C.month_start("occurrence_ts").alias("month_start"))
                .agg(F.count(F.lit(1)).alias("incidents"), _violent().alias("violent_incidents")))


def monthly_total(fact: DataFrame, f: Filters) -> DataFrame:
    return ordered(_monthly(fact, f), "month_start")


# W05 / W06 – 3-row rolling means (row-based, at least one row)
def _smooth(df: DataFrame, by: list[str]) -> DataFrame:
    w = Window.orderBy("month_start").rowsBetween(-2, 0)
    if by:
        w = Window.partitionBy(*by).orderBy("month_start").rowsBetween(-2, 0)
    return df.withColumns({
        "incidents_smooth": F.avg("incidents").over(w),
        "violent_incidents_smooth": F.avg("violent_incidents").over(w),
    })


def monthly_total_smooth(fact: DataFrame, f: Filters) -> DataFrame:
    """Input to the window is one row per month, so a single ordered partition is fine."""
    return ordered(_smooth(_monthly(fact, f), []), "month_start")


def monthly_trend_smooth(fact: DataFrame, f: Filters) -> DataFrame:
    return (_smooth(_monthly_by_type(fact, f), ["crime_description"])
            .orderBy("month_start", "crime_description"))


# Q11
def total_incidents(fact: DataFrame, f: Filters) -> DataFrame:
    return f.apply(fact).agg(F.count(F.lit(1)).alias("incidents"))


# Q12-Q14, Q16, Q17
def distribution(fact: DataFrame, f: Filters, column: str, limit: int | None = None,
                 extra: Column | None = None) -> DataFrame:
    g = (f.apply(fact if extra is None else fact.where(extra))
             .groupBy(C.blank_to_unknown(column).alias(column))
             .agg(F.count(F.lit(1)).alias("incidents")))
    if limit is None:
        return g.orderBy(F.col("incidents").desc(), F.col(column).asc_nulls_last())
    return _top(g, "incidents", column, limit)


def dist_sex(fact: DataFrame, f: Filters) -> DataFrame:
    return distribution(fact, f, "victim_sex")


def dist_age_group(fact: DataFrame, f: Filters) -> DataFrame:
    return distribution(fact, f, "victim_age_group")


def dist_descent(fact: DataFrame, f: Filters, limit: int = 20) -> DataFrame:
    return distribution(fact, f, "victim_descent", limit)


def top_weapons(fact: DataFrame, f: Filters, limit: int = 15) -> DataFrame:
    return distribution(fact, f, "weapon_description", limit, extra=F.col("has_weapon") == F.lit(True))


def top_premises(fact: DataFrame, f: Filters, limit: int = 15) -> DataFrame:
    return distribution(fact, f, "premise_description", limit)


# Q15
def weapon_share(fact: DataFrame, f: Filters) -> DataFrame:
    g = f.apply(fact).agg(
        F.coalesce(F.sum(F.when(F.col("has_weapon"), 1).otherwise(0)), F.lit(0))
         .cast("bigint").alias("with_weapon"),
        F.count(F.lit(1)).alias("total"))
    return g.withColumn("weapon_share", C.share("with_weapon", "total"))
