"""Registered queries (Spark) and their DuckDB oracles, with default parameters.

Each entry reads data that Spark derives from the star-schema tables of
``sf_dir`` and writes once per application (``refresh.layers``): the bronze
layer (cleaning, gold model and silver checks start there), the de-duplicated
gold fact and the daily mart (marts, dashboard metrics and exploration read
those), as in the source workflow where every notebook reads the table the
previous one wrote.

Oracle conventions: measures whose last bits depend on summation order
(averages of averages, standard deviations, z-scores) are rounded to 6 places
on both sides; everything else is compared as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import anomaly, areas, clean, explore, marts, metrics, model, quality
from ..operators.filters import Filters, default_period, in_types
from ..sources import adapter, landing, schemas
from . import oracle as O
from . import upsert
from .refresh import BRONZE, DIM_AREA, FACT, layers, upserted

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- default parameters --------------------------------------------------------
PERIOD = ("1997-01-01", "1998-12-31")
AREA = "03"
TYPES = ("MEDIUM TYPE 19", "MEDIUM TYPE 15")
TOP_N_SERIES = 8
LANDING_YEAR_FROM = 1996
INDEXED_YEAR_FROM = 2000
RUN_TS = "2024-01-01 00:00:00"

ALL = Filters(*PERIOD)
ALL_TYPES = Filters(*PERIOD, crime_types=TYPES)
VIOLENT_ONLY = Filters(*PERIOD, violence=codes.VIOLENCE_ONLY)
NON_VIOLENT = Filters(*PERIOD, violence=codes.VIOLENCE_NONE)
IN_AREA = Filters(*PERIOD, area_id=AREA)
IN_AREA_VIOLENT = Filters(*PERIOD, violence=codes.VIOLENCE_ONLY, area_id=AREA)


def _r(c: str, n: int = 6):
    return F.round(F.col(c), n).alias(c)


def _sql_where(f: Filters) -> str:
    parts = [f"occurrence_date BETWEEN DATE '{f.date_from}' AND DATE '{f.date_to}'"]
    if f.violence == codes.VIOLENCE_ONLY:
        parts.append("is_violent = true")
    elif f.violence == codes.VIOLENCE_NONE:
        parts.append("is_violent = false")
    vals = [t for t in f.crime_types if t]
    if vals:
        parts.append("crime_description IN (" + ", ".join(O.quote(v) for v in vals) + ")")
    if f.area_id:
        parts.append(f"area_id = {O.quote(f.area_id)}")
    return " AND ".join(parts)


# A version of a layer never changes, so a reader of its path (and its file listing) can be
# used again; the oldest are dropped.
_READERS: dict[tuple, DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, table: str, schema=None) -> DataFrame:
    step = {BRONZE: "bronze", FACT: "fact", f"gold/{DIM_AREA}": "areas"}.get(table) or table.removeprefix("gold/")
    found = layers(spark, sf_dir, step).now(spark)
    key = (id(spark), *found.paths(table))
    if key not in _READERS:
        while len(_READERS) >= 32:
            _READERS.pop(next(iter(_READERS)))
        _READERS[key] = found.read(spark, table, schema)
    return _READERS[key]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written bronze layer (derived from the star schema by the ingest step)."""
    return _read(spark, sf_dir, BRONZE, schemas.BRONZE)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, FACT, schemas.GOLD)


def mart(spark: SparkSession, sf_dir: str, name: str = "mart_crime_daily_area") -> DataFrame:
    return _read(spark, sf_dir, f"gold/{name}")


# === sources and layers ========================================================

_HAS_EXTRA = "cast(split_part(dr_no, '-', 1) AS BIGINT) % 51 = 0 AND dr_no LIKE '%-1'"
_EXTRA_SQL = (f"CASE WHEN {_HAS_EXTRA} THEN '{{\"location_2\":{{\"number\":' || split_part(dr_no, '-', 1)"
              " || ',\"street\":\"cross street\"}}' END")

_INGEST_SQL = O.with_prefix(f"""
SELECT dr_no, date_rptd, date_occ, time_occ, area, area_name, rpt_dist_no, part_1_2, crm_cd,
  crm_cd_desc, vict_age, vict_sex, vict_descent, premis_desc, weapon_desc, status_desc, lat, lon,
  DATE '{RUN_TS[:10]}' AS ingest_date, TIMESTAMP '{RUN_TS}' AS processing_datetime,
  'landing' AS data_source, {_EXTRA_SQL} AS extra
FROM bronze WHERE date_occ >= 'YEAR_FROM-01-01T00:00:00'""")


@register("bronze_ingest", _INGEST_SQL.replace("YEAR_FROM", str(LANDING_YEAR_FROM)))
def q_bronze_ingest(spark, sf_dir):
    found = landing.ingest(spark, layers(spark, sf_dir, "landing").landing_dir, year_from=LANDING_YEAR_FROM,
                           run_ts=RUN_TS, source="landing")
    return found.withColumn("extra", F.to_json("extra"))


@register("bronze_ingest_indexed", _INGEST_SQL.replace("YEAR_FROM", str(INDEXED_YEAR_FROM)))
def q_bronze_ingest_indexed(spark, sf_dir):
    """As ``bronze_ingest``; the skip index keeps files that end before the year from being read."""
    out = layers(spark, sf_dir, "landing")
    found = landing.ingest(spark, out.landing_dir, year_from=INDEXED_YEAR_FROM, run_ts=RUN_TS,
                           source="landing", index=out.landing_index)
    return found.withColumn("extra", F.to_json("extra"))


@register("landing_zones", O.with_prefix("""
SELECT count(*) AS records, min(date_occ) AS first_date, max(date_occ) AS last_date,
  count(*) FILTER (WHERE dr_no LIKE '%00-2') AS corrupt
FROM bronze"""))
def q_landing_zones(spark, sf_dir):
    """The skip index as a whole: what its files hold together."""
    zones = landing.read_index(spark, layers(spark, sf_dir, "landing").landing_index)
    return zones.agg(F.sum("records").alias("records"), F.min("first_date").alias("first_date"),
                     F.max("last_date").alias("last_date"), F.sum("corrupt").alias("corrupt"))


@register("dq_landing", O.with_prefix("""
SELECT count(*) AS records, count(*) FILTER (WHERE dr_no LIKE '%00-2') AS corrupt_lines,
  count(*) FILTER (WHERE """ + _HAS_EXTRA + ''') AS records_with_extra FROM bronze'''))
def q_dq_landing(spark, sf_dir):
    return landing.profile(landing.read_landing(spark, layers(spark, sf_dir, "landing").landing_dir))


@register("silver_clean", O.with_prefix("SELECT * FROM silver"))
def q_silver_clean(spark, sf_dir):
    return clean.silver(bronze(spark, sf_dir))


@register("gold_fact", O.with_prefix("SELECT * FROM gold_pre"))
def q_gold_fact(spark, sf_dir):
    return model.model(clean.silver(bronze(spark, sf_dir)))


@register("dedup_latest", O.with_prefix("SELECT * FROM fact"))
def q_dedup_latest(spark, sf_dir):
    return model.gold(clean.silver(bronze(spark, sf_dir)))


# === marts =====================================================================

@register("mart_daily_area", O.with_prefix("SELECT * FROM mart_daily_area"))
def q_mart_daily_area(spark, sf_dir):
    return marts.mart_daily_area(fact(spark, sf_dir))


@register("mart_hourly_pattern", O.with_prefix("""
SELECT weekday, hour_occ, crime_category, count(*) AS crime_count
FROM fact GROUP BY weekday, hour_occ, crime_category"""))
def q_mart_hourly_pattern(spark, sf_dir):
    return marts.mart_hourly_pattern(fact(spark, sf_dir))


@register("mart_type_trends", O.with_prefix("""
SELECT year, month, crime_category, count(*) AS crime_count,
  CAST(sum(CAST(is_violent AS INTEGER)) AS BIGINT) AS violent_count
FROM fact GROUP BY year, month, crime_category"""))
def q_mart_type_trends(spark, sf_dir):
    return marts.mart_type_trends(fact(spark, sf_dir))


@register("mart_monthly_area", O.with_prefix("""
SELECT area_id, area_name, CAST(year(occurrence_date) AS INTEGER) AS year,
  CAST(month(occurrence_date) AS INTEGER) AS month,
  count(*) AS crime_count,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_count,
  avg(reporting_delay_days) AS avg_reporting_delay_days,
  quantile_cont(reporting_delay_days, 0.5) AS median_reporting_delay_days,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS violent_share
FROM fact GROUP BY area_id, area_name, year(occurrence_date), month(occurrence_date)"""))
def q_mart_monthly_area(spark, sf_dir):
    return mart(spark, sf_dir, "mart_crime_monthly_area")


@register("mart_hourly_area", O.with_prefix("""
SELECT area_id, area_name, weekday, hour_occ, count(*) AS crime_count
FROM fact GROUP BY area_id, area_name, weekday, hour_occ"""))
def q_mart_hourly_area(spark, sf_dir):
    return mart(spark, sf_dir, "mart_crime_hourly_area")


# === data quality ==============================================================

@register("dq_null_profile", O.with_prefix("""
SELECT count(*) FILTER (WHERE dr_no IS NULL) AS dr_no,
  count(*) FILTER (WHERE occurrence_ts IS NULL) AS occurrence_ts,
  count(*) FILTER (WHERE crime_category IS NULL) AS crime_category,
  count(*) FILTER (WHERE area_id IS NULL) AS area_id,
  count(*) FILTER (WHERE area_name IS NULL) AS area_name
FROM fact"""))
def q_dq_null_profile(spark, sf_dir):
    return quality.null_profile(fact(spark, sf_dir))


@register("dq_geo_coverage", O.with_prefix("""
SELECT count(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL) AS rows_with_geo,
  count(*) AS total_rows FROM fact"""))
def q_dq_geo_coverage(spark, sf_dir):
    return quality.geo_coverage(fact(spark, sf_dir))


@register("dq_silver", O.with_prefix("""
SELECT count(*) FILTER (WHERE date_reported IS NULL) AS null_date_reported,
  count(*) FILTER (WHERE date_occ IS NULL) AS null_date_occ,
  count(*) FILTER (WHERE NOT (hour_occ BETWEEN 0 AND 23) OR NOT (minute_occ BETWEEN 0 AND 59))
    AS invalid_time,
  count(*) FILTER (WHERE victim_age IS NULL) AS null_victim_age,
  count(*) AS rows_before_geo,
  count(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0))
    AS rows_after_geo,
  count(*) - count(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0))
    AS rows_dropped_geo
FROM silver_typed"""))
def q_dq_silver(spark, sf_dir):
    return quality.silver_checks(bronze(spark, sf_dir))


@register("dq_gold_counts", O.with_prefix("""
SELECT count(*) AS rows, count(DISTINCT dr_no) AS distinct_dr_no, 30 AS columns FROM fact"""))
def q_dq_gold_counts(spark, sf_dir):
    return quality.gold_counts(fact(spark, sf_dir))


@register("silver_sex_freq", O.with_prefix("""
SELECT victim_sex, count(*) AS count FROM silver_typed GROUP BY victim_sex"""))
def q_silver_sex_freq(spark, sf_dir):
    return quality.silver_sex_freq(bronze(spark, sf_dir))


@register("silver_category_freq", O.with_prefix("""
SELECT crime_category, count(*) AS count FROM silver GROUP BY crime_category"""))
def q_silver_category_freq(spark, sf_dir):
    return quality.silver_category_freq(clean.silver(bronze(spark, sf_dir)))


# === exploration ===============================================================

@register("fact_span", O.with_prefix("""
SELECT count(*) AS total_incidents, min(occurrence_date) AS start_date,
  max(occurrence_date) AS end_date FROM fact"""))
def q_fact_span(spark, sf_dir):
    return explore.fact_span(fact(spark, sf_dir))


@register("daily_counts", O.with_prefix("""
SELECT occurrence_date, count(*) AS crime_count FROM fact GROUP BY occurrence_date
ORDER BY occurrence_date NULLS FIRST"""))
def q_daily_counts(spark, sf_dir):
    return explore.daily_counts(fact(spark, sf_dir))


@register("hourly_counts", O.with_prefix("""
SELECT hour_occ, count(*) AS crime_count FROM fact GROUP BY hour_occ"""))
def q_hourly_counts(spark, sf_dir):
    return explore.hourly_counts(fact(spark, sf_dir))


@register("hour_bucket_dist", O.with_prefix("""
SELECT CASE WHEN hour_occ BETWEEN 0 AND 5 THEN 'Night' WHEN hour_occ BETWEEN 6 AND 11 THEN 'Morning'
            WHEN hour_occ BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Evening' END AS hour_bucket,
  count(*) AS crime_count
FROM fact GROUP BY 1"""))
def q_hour_bucket_dist(spark, sf_dir):
    return explore.hour_bucket_dist(fact(spark, sf_dir))


@register("hourly_category_pivot", O.with_prefix("""
SELECT hour_occ,
  count(*) FILTER (WHERE crime_category = 'Non-Violent') AS "Non-Violent",
  count(*) FILTER (WHERE crime_category = 'Other') AS "Other",
  count(*) FILTER (WHERE crime_category = 'Violent') AS "Violent",
  count(*) FILTER (WHERE crime_category IS NULL OR crime_category NOT IN ('Non-Violent', 'Other', 'Violent'))
    AS other_values
FROM fact GROUP BY hour_occ ORDER BY hour_occ"""))
def q_hourly_category_pivot(spark, sf_dir):
    return explore.hourly_category_pivot(fact(spark, sf_dir))


@register("category_list", O.with_prefix("SELECT DISTINCT crime_category FROM fact"))
def q_category_list(spark, sf_dir):
    return explore.category_list(fact(spark, sf_dir))


@register("code_freq", O.with_prefix("""
SELECT crime_code, crime_description, count(*) AS crime_count
FROM fact GROUP BY crime_code, crime_description"""))
def q_code_freq(spark, sf_dir):
    return explore.code_freq(fact(spark, sf_dir))


@register("fact_macro", O.with_prefix("SELECT * FROM fact_macro"))
def q_fact_macro(spark, sf_dir):
    return explore.with_macro_category(fact(spark, sf_dir))


@register("macro_distribution", O.with_prefix("""
SELECT macro_category, count(*) AS crime_count,
  CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
FROM fact_macro GROUP BY macro_category"""))
def q_macro_distribution(spark, sf_dir):
    return explore.macro_distribution(fact(spark, sf_dir))


@register("other_share", O.with_prefix("""
SELECT count(*) FILTER (WHERE macro_category = 'Other / rare') AS other_count,
  count(*) AS total_count,
  CAST(count(*) FILTER (WHERE macro_category = 'Other / rare') AS DOUBLE) / count(*) AS other_share
FROM fact_macro"""))
def q_other_share(spark, sf_dir):
    return explore.other_share(fact(spark, sf_dir))


@register("other_breakdown", O.with_prefix("""
SELECT crime_code, crime_description, count(*) AS crime_count
FROM fact_macro WHERE macro_category = 'Other / rare' GROUP BY crime_code, crime_description"""))
def q_other_breakdown(spark, sf_dir):
    return explore.other_breakdown(fact(spark, sf_dir))


@register("area_summary", O.with_prefix("""
SELECT area_id, area_name, count(*) AS crime_count FROM fact GROUP BY area_id, area_name"""))
def q_area_summary(spark, sf_dir):
    return explore.area_summary(fact(spark, sf_dir))


_AREA_VIOLENT = """
area_violent AS (
 SELECT area_name, count(*) AS total_crimes,
  CASE WHEN area_name IS NULL THEN 0
       ELSE count(*) FILTER (WHERE macro_category = 'Violent crimes') END AS violent_crimes
 FROM fact_macro GROUP BY area_name
),
area_violent_share AS (
 SELECT *, CAST(violent_crimes AS DOUBLE) / total_crimes AS violent_share FROM area_violent
)"""


@register("area_violent_share", O.with_prefix("SELECT * FROM area_violent_share", _AREA_VIOLENT))
def q_area_violent_share(spark, sf_dir):
    return explore.area_violent_share(fact(spark, sf_dir))


@register("area_night_share", O.with_prefix("""
SELECT area_name, total_crimes, night_crimes,
  CAST(night_crimes AS DOUBLE) / total_crimes AS night_crime_share
FROM (SELECT area_name, count(*) AS total_crimes,
        CASE WHEN area_name IS NULL THEN 0
             ELSE count(*) FILTER (WHERE hour_occ BETWEEN 0 AND 5) END AS night_crimes
      FROM fact GROUP BY area_name) t"""))
def q_area_night_share(spark, sf_dir):
    return explore.area_night_share(fact(spark, sf_dir))


@register("area_share_top10_flagged", O.with_prefix("""
SELECT area_name, violent_share, violent_share * 100 AS violent_share_pct, violent_crimes,
  total_crimes, CAST(share_rank AS INTEGER) AS share_rank, total_rank <= 10 AS in_top_total
FROM (SELECT *,
        row_number() OVER (ORDER BY violent_share DESC NULLS LAST, area_name ASC NULLS LAST) AS share_rank,
        row_number() OVER (ORDER BY total_crimes DESC NULLS LAST, area_name ASC NULLS LAST) AS total_rank
      FROM area_violent_share) t
WHERE share_rank <= 10""", _AREA_VIOLENT))
def q_area_share_top10_flagged(spark, sf_dir):
    return explore.area_share_top10_flagged(fact(spark, sf_dir))


@register("type_reporting_delay", O.with_prefix("""
SELECT crime_code, crime_description, count(*) AS crime_count,
  quantile_disc(reporting_delay_days, 0.5) AS median_reporting_delay_days
FROM fact WHERE crime_code IS NOT NULL AND crime_description IS NOT NULL
GROUP BY crime_code, crime_description HAVING count(*) > 50"""))
def q_type_reporting_delay(spark, sf_dir):
    return explore.type_reporting_delay(fact(spark, sf_dir))


_TYPE_STATS = """
type_stats AS (
 SELECT crime_code, crime_description, count(*) AS crime_count,
  avg(CASE WHEN hour_occ BETWEEN 0 AND 5 THEN 1 ELSE 0 END) AS night_share,
  quantile_disc(hour_occ, 0.5) AS median_hour_occ,
  quantile_disc(reporting_delay_days, 0.5) AS median_reporting_delay_days
 FROM fact GROUP BY crime_code, crime_description HAVING count(*) > 50
)"""


@register("type_stats", O.with_prefix("SELECT * FROM type_stats", _TYPE_STATS))
def q_type_stats(spark, sf_dir):
    return explore.type_stats(fact(spark, sf_dir))


@register("night_leaning", O.with_prefix(
    "SELECT * FROM type_stats WHERE night_share >= 0.30", _TYPE_STATS))
def q_night_leaning(spark, sf_dir):
    return explore.night_leaning(fact(spark, sf_dir))


@register("night_fast_report", O.with_prefix("""
SELECT crime_code, crime_description, crime_count, night_share, median_hour_occ,
  median_reporting_delay_days
FROM type_stats WHERE night_share >= 0.30
ORDER BY median_reporting_delay_days ASC NULLS FIRST, crime_code ASC NULLS LAST,
  crime_description ASC NULLS LAST LIMIT 10""", _TYPE_STATS))
def q_night_fast_report(spark, sf_dir):
    return explore.night_fast_report(fact(spark, sf_dir))


@register("night_slow_report", O.with_prefix("""
SELECT crime_code, crime_description, crime_count, night_share, median_hour_occ,
  median_reporting_delay_days
FROM type_stats WHERE night_share >= 0.30
ORDER BY median_reporting_delay_days DESC NULLS LAST, crime_code ASC NULLS LAST,
  crime_description ASC NULLS LAST LIMIT 10""", _TYPE_STATS))
def q_night_slow_report(spark, sf_dir):
    return explore.night_slow_report(fact(spark, sf_dir))


@register("type_stats_top10", O.with_prefix("""
SELECT crime_code, crime_description, substr(crime_description, 1, 18) AS label, crime_count,
  night_share, median_reporting_delay_days
FROM type_stats
ORDER BY crime_count DESC, crime_code ASC NULLS LAST, crime_description ASC NULLS LAST LIMIT 10""",
    _TYPE_STATS))
def q_type_stats_top10(spark, sf_dir):
    return explore.type_stats_top10(fact(spark, sf_dir))


# === anomaly detection =========================================================

_ZSCORE = """
daily AS (
 SELECT occurrence_date, count(*) AS crime_count FROM fact
 WHERE occurrence_date IS NOT NULL GROUP BY occurrence_date
),
rolled AS (
 SELECT occurrence_date, crime_count,
  avg(crime_count) OVER w AS rolling_mean,
  stddev_samp(crime_count) OVER w AS rolling_std,
  count(crime_count) OVER w AS n
 FROM daily WINDOW w AS (ORDER BY occurrence_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
zscore AS (
 SELECT occurrence_date, crime_count, rolling_mean, rolling_std,
  CASE WHEN rolling_std > 0 THEN (crime_count - rolling_mean) / rolling_std END AS z_score,
  CASE WHEN rolling_std > 0 THEN abs((crime_count - rolling_mean) / rolling_std) >= 3
       ELSE crime_count <> rolling_mean END AS is_anomaly,
  strftime(occurrence_date, '%a') AS weekday,
  CAST(dayofmonth(occurrence_date) AS INTEGER) AS day_of_month
 FROM rolled WHERE n = 7
),
anoms AS (SELECT * FROM zscore WHERE is_anomaly)"""

_Z_COLS = ("occurrence_date, crime_count, round(rolling_mean, 6) AS rolling_mean, "
           "round(rolling_std, 6) AS rolling_std, round(z_score, 6) AS z_score")


def _zcols(df: DataFrame) -> DataFrame:
    return df.select(*[_r(c) if c in ("rolling_mean", "rolling_std", "z_score") else c
                       for c in df.columns])


@register("daily_zscore", O.with_prefix(
    f"SELECT {_Z_COLS}, is_anomaly, weekday, day_of_month FROM zscore", _ZSCORE))
def q_daily_zscore(spark, sf_dir):
    return _zcols(anomaly.daily_zscore(fact(spark, sf_dir)))


@register("daily_anomalies", O.with_prefix(
    f"SELECT {_Z_COLS}, is_anomaly, weekday, day_of_month FROM anoms", _ZSCORE))
def q_daily_anomalies(spark, sf_dir):
    return _zcols(anomaly.daily_anomalies(fact(spark, sf_dir)))


@register("top_anomalies", O.with_prefix(f"""
SELECT {_Z_COLS}, weekday, day_of_month FROM anoms
ORDER BY coalesce(abs(z_score), 'infinity'::DOUBLE) DESC, occurrence_date ASC LIMIT 30""",
    _ZSCORE))
def q_top_anomalies(spark, sf_dir):
    return _zcols(anomaly.top_anomalies(fact(spark, sf_dir)))


_ZSCORE_AREA = """
daily AS (
 SELECT area_id, occurrence_date, count(*) AS crime_count FROM fact
 WHERE occurrence_date IS NOT NULL GROUP BY area_id, occurrence_date
),
rolled AS (
 SELECT *, avg(crime_count) OVER w AS rolling_mean, stddev_samp(crime_count) OVER w AS rolling_std,
  count(crime_count) OVER w AS n
 FROM daily WINDOW w AS (PARTITION BY area_id ORDER BY occurrence_date
                         ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
anoms AS (
 SELECT *, strftime(occurrence_date, '%a') AS weekday, CAST(dayofmonth(occurrence_date) AS INTEGER) AS day_of_month,
  CASE WHEN rolling_std > 0 THEN (crime_count - rolling_mean) / rolling_std END AS z_score
 FROM rolled WHERE n = 7 AND CASE WHEN rolling_std > 0
   THEN abs((crime_count - rolling_mean) / rolling_std) >= 3 ELSE crime_count <> rolling_mean END
)"""


@register("top_anomalies_by_area", O.with_prefix(f"""
SELECT area_id, {_Z_COLS}, weekday, day_of_month FROM anoms
ORDER BY coalesce(abs(z_score), 'infinity'::DOUBLE) DESC, occurrence_date ASC, area_id ASC NULLS LAST LIMIT 30""",
    _ZSCORE_AREA))
def q_top_anomalies_by_area(spark, sf_dir):
    return _zcols(anomaly.top_anomalies(fact(spark, sf_dir), partition_cols=["area_id"]))


@register("anomaly_by_weekday", O.with_prefix("""
SELECT s.weekday, coalesce(c.n, 0) AS anomaly_days
FROM (SELECT unnest(['Mon','Tue','Wed','Thu','Fri','Sat','Sun']) AS weekday) s
LEFT JOIN (SELECT weekday, count(*) AS n FROM anoms GROUP BY weekday) c ON s.weekday = c.weekday""",
    _ZSCORE))
def q_anomaly_by_weekday(spark, sf_dir):
    return anomaly.anomaly_by_weekday(fact(spark, sf_dir))


@register("anomaly_by_dom", O.with_prefix("""
SELECT CAST(s.d AS INTEGER) AS day_of_month, coalesce(c.n, 0) AS anomaly_days
FROM range(1, 32) s(d)
LEFT JOIN (SELECT day_of_month, count(*) AS n FROM anoms GROUP BY day_of_month) c
  ON s.d = c.day_of_month""", _ZSCORE))
def q_anomaly_by_dom(spark, sf_dir):
    return anomaly.anomaly_by_dom(fact(spark, sf_dir))


# === dashboard metrics =========================================================

@register("date_bounds", O.with_prefix("""
SELECT min(occurrence_date) AS min_date, max(occurrence_date) AS max_date FROM mart_daily_area"""))
def q_date_bounds(spark, sf_dir):
    return metrics.date_bounds(mart(spark, sf_dir))


@register("default_period", O.with_prefix("""
SELECT greatest(min(occurrence_date), CAST(max(occurrence_date) - INTERVAL 365 DAY AS DATE)) AS date_from,
  max(occurrence_date) AS date_to FROM mart_daily_area"""))
def q_default_period(spark, sf_dir):
    return default_period(mart(spark, sf_dir))


_MAP_MART = f"""
SELECT area_id, area_name, CAST(sum(crime_count) AS BIGINT) AS crime_count,
  CAST(sum(violent_count) AS BIGINT) AS violent_count,
  round(avg(avg_reporting_delay_days), 6) AS avg_reporting_delay_days,
  round(avg(median_reporting_delay_days), 6) AS median_reporting_delay_days,
  CASE WHEN sum(crime_count) = 0 THEN 0.0
       ELSE CAST(sum(violent_count) AS DOUBLE) / sum(crime_count) END AS violent_share
FROM mart_daily_area
WHERE occurrence_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'
GROUP BY area_id, area_name"""


def _mart_rounded(df: DataFrame) -> DataFrame:
    return df.select(*[_r(c) if c in ("avg_reporting_delay_days", "median_reporting_delay_days")
                       else c for c in df.columns])


@register("map_agg_mart", O.with_prefix(_MAP_MART))
def q_map_agg_mart(spark, sf_dir):
    return _mart_rounded(metrics.map_agg_mart(mart(spark, sf_dir), *PERIOD))


def _top_sql(f: Filters, limit: int) -> str:
    return f"""
SELECT crime_description, count(*) AS incidents FROM fact
WHERE {_sql_where(Filters(f.date_from, f.date_to, f.violence))} AND crime_description IS NOT NULL
GROUP BY crime_description ORDER BY incidents DESC, crime_description ASC LIMIT {limit}"""


@register("top_types", O.with_prefix(_top_sql(ALL, 60)))
def q_top_types(spark, sf_dir):
    return metrics.top_types(fact(spark, sf_dir), ALL, 60)


@register("top_types_violent", O.with_prefix(_top_sql(VIOLENT_ONLY, 60)))
def q_top_types_violent(spark, sf_dir):
    return metrics.top_types(fact(spark, sf_dir), VIOLENT_ONLY, 60)


@register("top_types_nonviolent", O.with_prefix(_top_sql(NON_VIOLENT, 60)))
def q_top_types_nonviolent(spark, sf_dir):
    return metrics.top_types(fact(spark, sf_dir), NON_VIOLENT, 60)


@register("top_types_two_phase", O.with_prefix(_top_sql(ALL, 60)))
def q_top_types_two_phase(spark, sf_dir):
    """Summaries of 500 descriptions a task, then exact counts of those that may be in the top 60."""
    return metrics.top_types_two_phase(fact(spark, sf_dir), ALL, 60, size=500)


def _map_fact_sql(f: Filters) -> str:
    return f"""
SELECT area_id, area_name, count(*) AS crime_count,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_count,
  CASE WHEN count(*) = 0 THEN 0.0
       ELSE CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS DOUBLE) / count(*) END AS violent_share,
  avg(reporting_delay_days) AS avg_reporting_delay_days,
  quantile_disc(reporting_delay_days, 0.5) AS median_reporting_delay_days
FROM fact WHERE {_sql_where(f.without_area())}
GROUP BY area_id, area_name"""


@register("map_agg_fact", O.with_prefix(_map_fact_sql(ALL_TYPES)))
def q_map_agg_fact(spark, sf_dir):
    return metrics.map_agg_fact(fact(spark, sf_dir), ALL_TYPES)


@register("map_agg_fact_violent", O.with_prefix(_map_fact_sql(VIOLENT_ONLY)))
def q_map_agg_fact_violent(spark, sf_dir):
    return metrics.map_agg_fact(fact(spark, sf_dir), VIOLENT_ONLY)


@register("area_map", O.with_prefix(_MAP_MART))
def q_area_map(spark, sf_dir):
    return _mart_rounded(metrics.area_map(fact(spark, sf_dir), mart(spark, sf_dir), ALL))


@register("area_map_filtered", O.with_prefix(_map_fact_sql(NON_VIOLENT)))
def q_area_map_filtered(spark, sf_dir):
    return metrics.area_map(fact(spark, sf_dir), mart(spark, sf_dir), NON_VIOLENT)


@register("area_daily_series", O.with_prefix(f"""
SELECT occurrence_date, count(*) AS crime_count,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_count,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS violent_share
FROM fact WHERE {_sql_where(IN_AREA)} GROUP BY occurrence_date"""))
def q_area_daily_series(spark, sf_dir):
    return metrics.area_daily_series(fact(spark, sf_dir), IN_AREA)


@register("area_top_types", O.with_prefix(f"""
SELECT crime_description, count(*) AS incidents,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_incidents
FROM fact WHERE {_sql_where(IN_AREA)} AND crime_description IS NOT NULL
GROUP BY crime_description ORDER BY incidents DESC, crime_description ASC LIMIT 12"""))
def q_area_top_types(spark, sf_dir):
    return metrics.area_top_types(fact(spark, sf_dir), IN_AREA, 12)


def _monthly_trend_sql(where: str) -> str:
    return f"""
SELECT CAST(date_trunc('month', occurrence_ts) AS DATE) AS month_start, crime_description,
  count(*) AS incidents,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_incidents
FROM fact WHERE {where} AND crime_description IS NOT NULL
GROUP BY 1, crime_description"""


@register("monthly_trend", O.with_prefix(_monthly_trend_sql(_sql_where(ALL_TYPES))))
def q_monthly_trend(spark, sf_dir):
    return metrics.monthly_trend(fact(spark, sf_dir), ALL_TYPES)


_TOPN = f"""
topn AS (
 SELECT crime_description FROM fact
 WHERE {_sql_where(ALL)} AND crime_description IS NOT NULL
 GROUP BY crime_description ORDER BY count(*) DESC, crime_description ASC LIMIT {TOP_N_SERIES}
)"""


@register("monthly_trend_topn", O.with_prefix(_monthly_trend_sql(
    _sql_where(IN_AREA) + " AND crime_description IN (SELECT crime_description FROM topn)"), _TOPN))
def q_monthly_trend_topn(spark, sf_dir):
    return metrics.monthly_trend_topn(fact(spark, sf_dir), IN_AREA, TOP_N_SERIES)


@register("monthly_trend_smooth", O.with_prefix(f"""
SELECT *, avg(incidents) OVER w AS incidents_smooth,
  avg(violent_incidents) OVER w AS violent_incidents_smooth
FROM ({_monthly_trend_sql(_sql_where(ALL))}) t
WINDOW w AS (PARTITION BY crime_description ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def q_monthly_trend_smooth(spark, sf_dir):
    return metrics.monthly_trend_smooth(fact(spark, sf_dir), ALL)


def _weekday_hour_sql(f: Filters) -> str:
    return f"""
SELECT weekday, hour_occ, count(*) AS incidents FROM fact WHERE {_sql_where(f)}
GROUP BY weekday, hour_occ"""


@register("weekday_hour", O.with_prefix(_weekday_hour_sql(IN_AREA_VIOLENT)))
def q_weekday_hour(spark, sf_dir):
    return metrics.weekday_hour(fact(spark, sf_dir), IN_AREA_VIOLENT)


@register("weekday_hour_matrix", O.with_prefix(
    "SELECT weekday, " + ", ".join(
        f"CAST(coalesce(sum(incidents) FILTER (WHERE hour_occ = {h}), 0) AS BIGINT) AS h{h:02d}"
        for h in range(24))
    + ", CAST(coalesce(sum(incidents) FILTER (WHERE hour_occ IS NULL OR hour_occ NOT BETWEEN 0 AND 23), 0)"
      " AS BIGINT) AS h_other"
    + f" FROM ({_weekday_hour_sql(ALL)}) t GROUP BY weekday"))
def q_weekday_hour_matrix(spark, sf_dir):
    return metrics.weekday_hour_matrix(fact(spark, sf_dir), ALL)


@register("area_list", O.with_prefix("""
SELECT DISTINCT area_id, area_name FROM mart_daily_area
WHERE area_id IS NOT NULL AND area_name IS NOT NULL"""))
def q_area_list(spark, sf_dir):
    return metrics.area_list(mart(spark, sf_dir))


LOOKUP_AREA_NAME = "NATION 3"


@register("area_lookup", O.with_prefix(f"""
SELECT min(area_id) AS area_id FROM (
 SELECT DISTINCT area_id, area_name FROM mart_daily_area
 WHERE area_id IS NOT NULL AND area_name IS NOT NULL) t
WHERE area_name = {O.quote(LOOKUP_AREA_NAME)}"""))
def q_area_lookup(spark, sf_dir):
    return metrics.area_id_for_name(metrics.area_list(mart(spark, sf_dir)), LOOKUP_AREA_NAME)


def _monthly_total_sql(f: Filters) -> str:
    return f"""
SELECT CAST(date_trunc('month', occurrence_ts) AS DATE) AS month_start, count(*) AS incidents,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_incidents
FROM fact WHERE {_sql_where(f)} GROUP BY 1"""


@register("monthly_total", O.with_prefix(_monthly_total_sql(IN_AREA)))
def q_monthly_total(spark, sf_dir):
    return metrics.monthly_total(fact(spark, sf_dir), IN_AREA)


@register("monthly_total_smooth", O.with_prefix(f"""
SELECT *, avg(incidents) OVER w AS incidents_smooth,
  avg(violent_incidents) OVER w AS violent_incidents_smooth
FROM ({_monthly_total_sql(ALL)}) t
WINDOW w AS (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def q_monthly_total_smooth(spark, sf_dir):
    return metrics.monthly_total_smooth(fact(spark, sf_dir), ALL)


@register("total_incidents", O.with_prefix(
    f"SELECT count(*) AS incidents FROM fact WHERE {_sql_where(ALL_TYPES)}"))
def q_total_incidents(spark, sf_dir):
    return metrics.total_incidents(fact(spark, sf_dir), ALL_TYPES)


def _dist_sql(column: str, f: Filters, limit: int | None = None, extra: str = "") -> str:
    expr = f"coalesce(nullif(trim({column}), ''), 'Unknown')"
    tail = f" ORDER BY incidents DESC, {column} ASC LIMIT {limit}" if limit else ""
    return f"""
SELECT {expr} AS {column}, count(*) AS incidents FROM fact
WHERE {_sql_where(f)}{extra} GROUP BY {expr}{tail}"""


@register("dist_sex", O.with_prefix(_dist_sql("victim_sex", ALL)))
def q_dist_sex(spark, sf_dir):
    return metrics.dist_sex(fact(spark, sf_dir), ALL)


@register("dist_age_group", O.with_prefix(_dist_sql("victim_age_group", IN_AREA)))
def q_dist_age_group(spark, sf_dir):
    return metrics.dist_age_group(fact(spark, sf_dir), IN_AREA)


@register("dist_descent", O.with_prefix(_dist_sql("victim_descent", ALL, 20)))
def q_dist_descent(spark, sf_dir):
    return metrics.dist_descent(fact(spark, sf_dir), ALL, 20)


@register("weapon_share", O.with_prefix(f"""
SELECT CAST(coalesce(sum(CASE WHEN has_weapon THEN 1 ELSE 0 END), 0) AS BIGINT) AS with_weapon,
  count(*) AS total,
  CASE WHEN count(*) = 0 THEN 0.0
       ELSE CAST(coalesce(sum(CASE WHEN has_weapon THEN 1 ELSE 0 END), 0) AS DOUBLE) / count(*)
  END AS weapon_share
FROM fact WHERE {_sql_where(VIOLENT_ONLY)}"""))
def q_weapon_share(spark, sf_dir):
    return metrics.weapon_share(fact(spark, sf_dir), VIOLENT_ONLY)


@register("top_weapons", O.with_prefix(
    _dist_sql("weapon_description", ALL, 15, " AND has_weapon = true")))
def q_top_weapons(spark, sf_dir):
    return metrics.top_weapons(fact(spark, sf_dir), ALL, 15)


@register("top_premises", O.with_prefix(_dist_sql("premise_description", IN_AREA, 15)))
def q_top_premises(spark, sf_dir):
    return metrics.top_premises(fact(spark, sf_dir), IN_AREA, 15)


# === area polygons =============================================================

def _geo_sql() -> str:
    """The derived polygon dimension, built from the fact like the Spark side."""
    def pt(x: str, y: str) -> str:
        return f"printf('[%.4f,%.4f]', {x}, {y})"
    geometry = ("concat('{\"type\":\"Polygon\",\"coordinates\":[[', concat_ws(',', "
                + ", ".join([pt("x0", "y0"), pt("x1", "y0"), pt("x1", "y1"), pt("x0", "y1"),
                             pt("x0", "y0")])
                + "), ']]}')")
    prec_text = (f"CASE WHEN k = {adapter.NULL_PREC_AREA} THEN NULL "
                 "WHEN k % 4 = 1 THEN concat(CAST(k AS VARCHAR), '.0') "
                 f"WHEN k % 4 = 2 THEN {O._pad('CAST(k AS VARCHAR)', 2)} "
                 "ELSE coalesce(CAST(k AS VARCHAR), raw) END")
    no_label = f"(coalesce(k = {adapter.NO_LABEL_AREA}, false) OR nm IS NULL)"
    aprec = (f"CASE WHEN {no_label} THEN NULL WHEN k % 3 = 0 THEN '' "
             "WHEN k % 3 = 1 THEN concat(' ', nm, ' ') END")
    name = f"CASE WHEN {no_label} THEN NULL ELSE concat(nm, ' DIVISION') END"
    area_id = (f"coalesce(CAST(try_cast(trunc(try_cast(({prec_text}) AS DOUBLE)) AS BIGINT) AS VARCHAR), "
               f"trim({prec_text}), '')")
    area_name = f"trim(coalesce(nullif({aprec}, ''), nullif({name}, ''), ''))"
    return f"""
dim_boxes AS (
 SELECT area_id AS raw, try_cast(area_id AS INTEGER) AS k, min(lat) AS y0, max(lat) AS y1,
  min(lon) AS x0, max(lon) AS x1, max(area_name) AS nm
 FROM fact WHERE lat IS NOT NULL AND lon IS NOT NULL AND area_id IS NOT NULL
 GROUP BY area_id
),
dim_area_geo AS (
 SELECT {area_id} AS area_id, {area_name} AS area_name, {geometry} AS geojson
 FROM dim_boxes
)"""


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, f"gold/{DIM_AREA}", schemas.DIM_AREA_GEO)


@register("dim_area_geo", O.with_prefix("SELECT * FROM dim_area_geo", _geo_sql()))
def q_dim_area_geo(spark, sf_dir):
    return _dim(spark, sf_dir)


@register("area_map_geo", O.with_prefix("""
SELECT m.* EXCLUDE (k), m.k AS area_id_norm, g.area_name AS geo_area_name, g.geojson
FROM (SELECT *, coalesce(CAST(try_cast(trunc(try_cast(area_id AS DOUBLE)) AS BIGINT) AS VARCHAR),
                         trim(area_id), '') AS k FROM map_mart) m
LEFT JOIN dim_area_geo g ON m.k = g.area_id""", _geo_sql() + ", map_mart AS (" + _MAP_MART + ")"))
def q_area_map_geo(spark, sf_dir):
    m = _mart_rounded(metrics.area_map(fact(spark, sf_dir), mart(spark, sf_dir), ALL))
    return areas.area_map_geo(m, _dim(spark, sf_dir))


@register("area_map_geo_filtered", O.with_prefix("""
SELECT m.* EXCLUDE (k), m.k AS area_id_norm, g.area_name AS geo_area_name, g.geojson
FROM (SELECT *, coalesce(CAST(try_cast(trunc(try_cast(area_id AS DOUBLE)) AS BIGINT) AS VARCHAR),
                         trim(area_id), '') AS k FROM map_fact) m
LEFT JOIN dim_area_geo g ON m.k = g.area_id""",
    _geo_sql() + ", map_fact AS (" + _map_fact_sql(VIOLENT_ONLY) + ")"))
def q_area_map_geo_filtered(spark, sf_dir):
    m = metrics.area_map(fact(spark, sf_dir), mart(spark, sf_dir), VIOLENT_ONLY)
    return areas.area_map_geo(m, _dim(spark, sf_dir))


# Row order of the results that have one: "-c" descending, "c" ascending (nulls last in
# both), "^c" ascending with nulls first. ``weekday`` is in calendar order.
ORDERS: dict[str, tuple[str, ...]] = {
    "daily_counts": ("^occurrence_date",),
    "hourly_counts": ("^hour_occ",),
    "hourly_category_pivot": ("^hour_occ",),
    "code_freq": ("-crime_count", "crime_code", "crime_description"),
    "macro_distribution": ("-crime_count", "macro_category"),
    "other_breakdown": ("-crime_count", "crime_code", "crime_description"),
    "area_summary": ("-crime_count", "area_id", "area_name"),
    "area_violent_share": ("-violent_share", "area_name"),
    "area_night_share": ("-night_crime_share", "area_name"),
    "area_share_top10_flagged": ("share_rank",),
    "type_reporting_delay": ("-median_reporting_delay_days", "crime_code", "crime_description"),
    "night_leaning": ("-crime_count", "crime_code", "crime_description"),
    "night_fast_report": ("^median_reporting_delay_days", "crime_code", "crime_description"),
    "night_slow_report": ("-median_reporting_delay_days", "crime_code", "crime_description"),
    "type_stats_top10": ("-crime_count", "crime_code", "crime_description"),
    "silver_sex_freq": ("-count", "victim_sex"),
    "area_daily_series": ("occurrence_date",),
    "monthly_trend": ("month_start", "crime_description"),
    "monthly_trend_topn": ("month_start", "crime_description"),
    "monthly_trend_smooth": ("month_start", "crime_description"),
    "monthly_total": ("month_start",),
    "monthly_total_smooth": ("month_start",),
    "area_list": ("area_name", "area_id"),
    "top_types": ("-incidents", "crime_description"),
    "top_types_violent": ("-incidents", "crime_description"),
    "top_types_nonviolent": ("-incidents", "crime_description"),
    "area_top_types": ("-incidents", "crime_description"),
    "dist_sex": ("-incidents", "victim_sex"),
    "dist_age_group": ("-incidents", "victim_age_group"),
    "dist_descent": ("-incidents", "victim_descent"),
    "top_weapons": ("-incidents", "weapon_description"),
    "top_premises": ("-incidents", "premise_description"),
    "anomaly_by_dom": ("day_of_month",),
}


# === incremental refresh ===========================================================
# the fact and marts after three batches: records, changed records, late and tied versions

@register("fact_after_batches", O.with_batches("SELECT * FROM fact"))
def q_fact_after_batches(spark, sf_dir):
    return upsert.fact(spark, upserted(spark, sf_dir))


@register("daily_mart_after_batches", O.with_batches("SELECT * FROM mart_daily_area"))
def q_daily_mart_after_batches(spark, sf_dir):
    return upserted(spark, sf_dir).read(spark, "gold/mart_crime_daily_area")


@register("monthly_mart_after_batches", O.with_batches("""
SELECT area_id, area_name, CAST(year(occurrence_date) AS INTEGER) AS year,
  CAST(month(occurrence_date) AS INTEGER) AS month, count(*) AS crime_count,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_count,
  avg(reporting_delay_days) AS avg_reporting_delay_days,
  quantile_cont(reporting_delay_days, 0.5) AS median_reporting_delay_days,
  CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS violent_share
FROM fact GROUP BY ALL"""))
def q_monthly_mart_after_batches(spark, sf_dir):
    return upserted(spark, sf_dir).read(spark, "gold/mart_crime_monthly_area")


@register("period_median_delay", O.with_batches(f"""
SELECT area_id, crime_category, count(*) AS crime_count,
  avg(reporting_delay_days) AS avg_reporting_delay_days,
  quantile_cont(reporting_delay_days, 0.5) AS median_reporting_delay_days
FROM fact WHERE occurrence_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'
GROUP BY area_id, crime_category"""))
def q_period_median_delay(spark, sf_dir):
    """Exact medians of a period from the counted delays of the marts' state."""
    state = upserted(spark, sf_dir).read(spark, upsert.STATE)
    return upsert.period_median(state, *PERIOD, ["area_id", "crime_category"])


# === long series, long lists ========================================================
@register("daily_zscore_blocks", O.with_prefix(
    f"SELECT {_Z_COLS}, is_anomaly, weekday, day_of_month FROM zscore", _ZSCORE))
def q_daily_zscore_blocks(spark, sf_dir):
    """As ``daily_zscore``, in blocks of 30 days that each get the days before as a halo."""
    return _zcols(anomaly.daily_zscore(fact(spark, sf_dir), block_days=30))


_LISTED = "SELECT DISTINCT crime_description FROM fact WHERE is_violent AND victim_age >= 90"


@register("trend_of_listed_types", O.with_prefix(f"""
SELECT cast(date_trunc('month', occurrence_ts) AS DATE) AS month_start, crime_description,
  count(*) AS incidents, CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS violent_incidents
FROM fact WHERE {_sql_where(ALL)} AND crime_description IN ({_LISTED})
GROUP BY 1, 2 ORDER BY 1, 2"""))
def q_trend_of_listed_types(spark, sf_dir):
    """The monthly trend of the types that a table lists (those with very old victims)."""
    f = fact(spark, sf_dir)
    listed = f.where("is_violent AND victim_age >= 90").select("crime_description")
    return metrics.monthly_trend(in_types(f, listed), ALL)


ORDERS["trend_of_listed_types"] = ("month_start", "crime_description")
ORDERS["top_types_two_phase"] = ORDERS["top_types"]
