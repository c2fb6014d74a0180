"""Exploratory summaries of the gold fact.

Self-joins of "totals ⟕ filtered subset" are rewritten as one conditional
aggregation (one scan, one shuffle). Windows used for shares and ranks run on
already-aggregated rows (one per category/area/type), never on incidents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C
from .order import ordered


def _type_tiebreak() -> list:
    return [F.col("crime_code").asc_nulls_last(), F.col("crime_description").asc_nulls_last()]


def _by_count() -> list:
    return [F.col("crime_count").desc(), *_type_tiebreak()]


def _cnt(name: str = "crime_count"):
    return F.count(F.lit(1)).alias(name)


# P24
def with_macro_category(fact: DataFrame) -> DataFrame:
    return fact.withColumn("macro_category", C.macro_category("crime_code"))


# A11
def fact_span(fact: DataFrame) -> DataFrame:
    return fact.agg(_cnt("total_incidents"), F.min("occurrence_date").alias("start_date"),
                    F.max("occurrence_date").alias("end_date"))


# A12
def daily_counts(fact: DataFrame) -> DataFrame:
    return ordered(fact.groupBy("occurrence_date").agg(_cnt()), "occurrence_date")


# A13
def hourly_counts(fact: DataFrame) -> DataFrame:
    return ordered(fact.groupBy("hour_occ").agg(_cnt()), "hour_occ")


# P20 distribution
def hour_bucket_dist(fact: DataFrame) -> DataFrame:
    return fact.groupBy(C.hour_bucket("hour_occ").alias("hour_bucket")).agg(_cnt())


CATEGORIES = [codes.NON_VIOLENT, codes.OTHER, codes.VIOLENT]


# A14 – hour x category, wide, missing cells 0
def hourly_category_pivot(fact: DataFrame) -> DataFrame:
    """Pivot over the category list as one conditional aggregation (one shuffle, where
    ``groupBy().pivot()`` plans two aggregations). ``other_values`` counts the incidents
    of any category outside the list, null included, so none is lost."""
    category = F.col("crime_category")
    listed = F.coalesce(category.isin(*CATEGORIES), F.lit(False))
    return ordered(fact.groupBy("hour_occ").agg(
        *[F.count_if(category == F.lit(c)).alias(c) for c in CATEGORIES],
        F.count_if(~listed).alias("other_values")), "hour_occ")


# A15
def category_list(fact: DataFrame) -> DataFrame:
    return fact.select("crime_category").distinct()


# A16
def code_freq(fact: DataFrame) -> DataFrame:
    return fact.groupBy("crime_code", "crime_description").agg(_cnt()).orderBy(*_by_count())


# A17 + W02
def macro_distribution(fact: DataFrame) -> DataFrame:
    g = with_macro_category(fact).groupBy("macro_category").agg(_cnt())
    # share of the grand total over the (at most 8) aggregated rows
    shared = g.withColumn("share", F.col("crime_count") / F.sum("crime_count").over(Window.partitionBy()))
    return ordered(shared, F.col("crime_count").desc(), "macro_category")


# A18
def other_share(fact: DataFrame) -> DataFrame:
    m = with_macro_category(fact)
    g = m.agg(F.count_if(F.col("macro_category") == F.lit(codes.MACRO_OTHER)).alias("other_count"),
              _cnt("total_count"))
    return g.withColumn("other_share", C.share("other_count", "total_count"))


# A19
def other_breakdown(fact: DataFrame) -> DataFrame:
    return (with_macro_category(fact)
            .where(F.col("macro_category") == F.lit(codes.MACRO_OTHER))
            .groupBy("crime_code", "crime_description").agg(_cnt()).orderBy(*_by_count()))


# A20
def area_summary(fact: DataFrame) -> DataFrame:
    return ordered(fact.groupBy("area_id", "area_name").agg(_cnt()), F.col("crime_count").desc(),
                   F.col("area_id").asc_nulls_last(), F.col("area_name").asc_nulls_last())


def _area_subset_share(fact: DataFrame, subset, part: str, share: str) -> DataFrame:
    """Per area_name: total, subset count and share. A null area_name never matched
    the subset in the join formulation, so its subset count is 0."""
    g = fact.groupBy("area_name").agg(_cnt("total_crimes"), F.count_if(subset).alias("_n"))
    return (g.withColumn(part, F.when(F.col("area_name").isNull(), F.lit(0).cast("bigint"))
                                 .otherwise(F.col("_n")))
             .drop("_n")
             .withColumn(share, F.col(part) / F.col("total_crimes")))


def _largest(measure: str, label: str = "area_name") -> list:
    return [F.col(measure).desc(), F.col(label).asc_nulls_last()]


def _area_violent(fact: DataFrame) -> DataFrame:
    return _area_subset_share(with_macro_category(fact),
                              F.col("macro_category") == F.lit(codes.MACRO_VIOLENT),
                              "violent_crimes", "violent_share")


# J01
def area_violent_share(fact: DataFrame) -> DataFrame:
    return ordered(_area_violent(fact), *_largest("violent_share"))


# J02
def area_night_share(fact: DataFrame) -> DataFrame:
    s = _area_subset_share(fact, C.is_night("hour_occ"), "night_crimes", "night_crime_share")
    return ordered(s, *_largest("night_crime_share"))


# J04 + T04 – top-10 by violent share, flagged when also top-10 by total
def area_share_top10_flagged(fact: DataFrame, n: int = 10) -> DataFrame:
    """Two top-n selections (each task keeps n rows) and a join of n rows with n rows;
    only the n selected rows are ranked."""
    s = _area_violent(fact)
    top_share, top_total = (s.orderBy(*_largest(m)).limit(n) for m in ("violent_share", "total_crimes"))
    flag = top_total.select(F.col("area_name").alias("_area"), F.lit(True).alias("_top"))
    rank = F.row_number().over(Window.orderBy(*_largest("violent_share")))
    return (top_share.join(flag, F.col("area_name").eqNullSafe(F.col("_area")), "left")
            .select("area_name", "violent_share",
                    (F.col("violent_share") * 100).alias("violent_share_pct"), "violent_crimes",
                    "total_crimes", rank.alias("share_rank"),
                    F.coalesce("_top", F.lit(False)).alias("in_top_total"))
            .orderBy("share_rank"))


# J03 + A22 – types seen more than 50 times, approximate median delay
def type_reporting_delay(fact: DataFrame, min_count: int = codes.MIN_TYPE_COUNT) -> DataFrame:
    return (fact.where(F.col("crime_code").isNotNull() & F.col("crime_description").isNotNull())
                .groupBy("crime_code", "crime_description")
                .agg(_cnt(), F.percentile_approx("reporting_delay_days", 0.5)
                     .alias("median_reporting_delay_days"))
                .where(F.col("crime_count") > min_count)
                .orderBy(F.col("median_reporting_delay_days").desc_nulls_last(), *_type_tiebreak()))


# A21
def type_stats(fact: DataFrame, min_count: int = codes.MIN_TYPE_COUNT) -> DataFrame:
    night = F.when(C.is_night("hour_occ"), F.lit(1)).otherwise(F.lit(0))
    return (fact.groupBy("crime_code", "crime_description")
                .agg(_cnt(), F.avg(night).alias("night_share"),
                     F.percentile_approx("hour_occ", 0.5).alias("median_hour_occ"),
                     F.percentile_approx("reporting_delay_days", 0.5)
                      .alias("median_reporting_delay_days"))
                .where(F.col("crime_count") > min_count))


TYPE_COLUMNS = ["crime_code", "crime_description", "crime_count", "night_share",
                "median_hour_occ", "median_reporting_delay_days"]


# T06
def _night_leaning(fact: DataFrame, min_share: float = codes.NIGHT_SHARE_MIN) -> DataFrame:
    return type_stats(fact).where(F.col("night_share") >= F.lit(min_share))


def night_leaning(fact: DataFrame, min_share: float = codes.NIGHT_SHARE_MIN) -> DataFrame:
    return _night_leaning(fact, min_share).orderBy(*_by_count())


def night_fast_report(fact: DataFrame, n: int = 10) -> DataFrame:
    return (_night_leaning(fact)
            .orderBy(F.col("median_reporting_delay_days").asc_nulls_first(), *_type_tiebreak())
            .select(*TYPE_COLUMNS).limit(n))


def night_slow_report(fact: DataFrame, n: int = 10) -> DataFrame:
    return (_night_leaning(fact)
            .orderBy(F.col("median_reporting_delay_days").desc_nulls_last(), *_type_tiebreak())
            .select(*TYPE_COLUMNS).limit(n))


# T07
def type_stats_top10(fact: DataFrame, n: int = 10) -> DataFrame:
    return (type_stats(fact)
            .orderBy(F.col("crime_count").desc(), *_type_tiebreak())
            .limit(n)
            .select("crime_code", "crime_description", C.label("crime_description").alias("label"),
                    "crime_count", "night_share", "median_reporting_delay_days"))
