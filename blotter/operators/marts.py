"""Pre-aggregated marts over the gold fact (one hash aggregation each).

Every mart is a partial + final aggregation on its keys: map tasks combine
before the shuffle, so the shuffle carries one row per key per task. The exact
median (``percentile``) keeps a value -> count map per group; delays are whole
days, so that map is bounded by the number of distinct delays, not by rows.
No global sort is applied before writing: no reader depends on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def _violent_count() -> Column:
    return F.sum(F.col("is_violent").cast("int"))


def _violent_count_or_zero() -> Column:
    """The monthly mart's rule: a null flag counts as not violent."""
    return F.sum(F.when(F.col("is_violent"), F.lit(1)).otherwise(F.lit(0)))


def _area_measures(violent: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("crime_count"),
        violent.alias("violent_count"),
        F.avg("reporting_delay_days").alias("avg_reporting_delay_days"),
        F.percentile(F.col("reporting_delay_days"), F.lit(0.5)).alias("median_reporting_delay_days"),
    ]


def mart_daily_area(fact: DataFrame) -> DataFrame:
    """Per (occurrence_date, area): counts, average and exact median delay, share."""
    return (fact.groupBy("occurrence_date", "area_id", "area_name")
                .agg(*_area_measures(_violent_count()))
                .withColumn("violent_share", C.share("violent_count", "crime_count")))


def mart_hourly_pattern(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("weekday", "hour_occ", "crime_category")
                .agg(F.count(F.lit(1)).alias("crime_count")))


def mart_type_trends(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("year", "month", "crime_category")
                .agg(F.count(F.lit(1)).alias("crime_count"),
                     _violent_count().alias("violent_count")))


def mart_monthly_area(fact: DataFrame) -> DataFrame:
    """As the daily mart, per calendar month of ``occurrence_date``."""
    d = F.col("occurrence_date")
    return (fact.groupBy("area_id", "area_name", F.year(d).alias("year"), F.month(d).alias("month"))
                .agg(*_area_measures(_violent_count_or_zero()))
                .withColumn("violent_share", C.share("violent_count", "crime_count")))


def mart_hourly_area(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("area_id", "area_name", "weekday", "hour_occ")
                .agg(F.count(F.lit(1)).alias("crime_count")))


MARTS = {
    "mart_crime_daily_area": mart_daily_area,
    "mart_crime_hourly_pattern": mart_hourly_pattern,
    "mart_crime_type_trends": mart_type_trends,
    "mart_crime_monthly_area": mart_monthly_area,
    "mart_crime_hourly_area": mart_hourly_area,
}
