"""Data-quality checks, each a single aggregation pass (one job per check)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import columns as C
from . import clean
from .order import ordered

KEY_COLUMNS = ["dr_no", "occurrence_ts", "crime_category", "area_id", "area_name"]


def _nulls(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def _geo() -> list[Column]:
    return [F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("rows_with_geo"),
            F.count(F.lit(1)).alias("total_rows")]


def _silver() -> list[Column]:
    """Counters of typed rows before the geo filter."""
    return [F.count_if(F.col("date_reported").isNull()).alias("null_date_reported"),
            F.count_if(F.col("date_occ").isNull()).alias("null_date_occ"),
            F.count_if(C.invalid_time("hour_occ", "minute_occ")).alias("invalid_time"),
            F.count_if(F.col("victim_age").isNull()).alias("null_victim_age"),
            F.count(F.lit(1)).alias("rows_before_geo"),
            F.count_if(C.geo_valid("lat", "lon")).alias("rows_after_geo")]


# A06
def null_profile(fact: DataFrame, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    return fact.agg(*_nulls(columns))


# A07
def geo_coverage(fact: DataFrame) -> DataFrame:
    return fact.agg(*_geo())


# A08 – every silver counter from one pass over the typed rows (before the geo filter)
def silver_checks(bronze: DataFrame) -> DataFrame:
    return clean.typed(bronze).agg(*_silver()).withColumn(
        "rows_dropped_geo", F.col("rows_before_geo") - F.col("rows_after_geo"))


# A09
def gold_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_distinct("dr_no").alias("distinct_dr_no"),
                    F.lit(len(fact.columns)).alias("columns"))


# A10
def silver_sex_freq(bronze: DataFrame) -> DataFrame:
    counts = clean.typed(bronze).groupBy("victim_sex").agg(F.count(F.lit(1)).alias("count"))
    return ordered(counts, F.col("count").desc(), "victim_sex")


def silver_category_freq(silver: DataFrame) -> DataFrame:
    return silver.groupBy("crime_category").agg(F.count(F.lit(1)).alias("count"))


# A06-A09 in the pass that writes a table: no scan of their own. A metric observed in the stage
# that writes counts each row once, however often a task is tried.
#: relative error of the distinct ids that a sketch counts
SKETCH_ERROR = 0.01


def observed_silver(typed: DataFrame) -> tuple[DataFrame, Observation]:
    """Typed rows that count A08 as they are written."""
    seen = Observation()
    return typed.observe(seen, *_silver()), seen


def observed_fact(fact: DataFrame) -> tuple[DataFrame, Observation]:
    """A fact that counts A06, A07 and A09 as it is written; ids are counted by a sketch."""
    seen = Observation()
    nulls = [c.alias(f"null_{n}") for n, c in zip(KEY_COLUMNS, _nulls(KEY_COLUMNS))]
    return fact.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls, *_geo(),
                        F.approx_count_distinct("dr_no", SKETCH_ERROR).alias("dr_no_sketch")), seen


def sketch_doubts(counts: dict) -> bool:
    """Whether the sketch leaves it open that an id stands more than once; it takes an exact
    count then."""
    rows = counts["rows"] - counts["null_dr_no"]
    return counts["null_dr_no"] > 1 or counts["dr_no_sketch"] < rows * (1 - 4 * SKETCH_ERROR)
