"""Equivalent SQL for DuckDB, used as the correctness oracle.

One shared CTE prefix rebuilds bronze -> silver -> gold from the pre-registered
star-schema views with the same rules as the Spark code; every oracle is
``WITH <prefix>, <local CTEs> <tail>``. Conventions shared with the Spark side:
floating measures that depend on summation order are rounded to 6 places;
DuckDB ``sum`` of integers is cast back to BIGINT; null ordering is explicit.
"""

from __future__ import annotations

from ..functions import codes
from ..sources import schemas
from ..sources.adapter import CODE_BY_SIZE


def quote(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _pad(expr: str, n: int) -> str:
    """Zero-padded to n characters, longer text kept whole."""
    return f"CASE WHEN length({expr}) >= {n} THEN {expr} ELSE lpad({expr}, {n}, '0') END"


def _norm(c: str) -> str:
    return f"regexp_replace(trim({c}), '\\s+', ' ', 'g')"


BRONZE = f"""
bronze AS (
 SELECT
  concat(cast(l_orderkey AS VARCHAR), '-', cast(l_linenumber AS VARCHAR)) AS dr_no,
  CASE WHEN l_orderkey % 503 = 0 THEN NULL
       ELSE concat(cast(cast(o_orderdate AS DATE) AS VARCHAR), 'T00:00:00.000') END AS date_occ,
  concat(cast(cast(o_orderdate AS DATE) + cast((l_orderkey * 7 + l_linenumber * 13) % 40 - 3 AS INTEGER) AS VARCHAR),
         'T00:00:00.000') AS date_rptd,
  CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE lpad(cast(
    (CASE WHEN p_size % 5 = 0 AND l_orderkey % 2 = 0 THEN l_orderkey % 6
          ELSE (l_partkey * 37 + l_linenumber * 11) % 25 END) * 100
    + (l_suppkey * 7 + l_orderkey) % 60 AS VARCHAR), 4, '0') END AS time_occ,
  {_pad('cast(n_nationkey AS VARCHAR)', 2)} AS area,
  CASE WHEN n_nationkey = 24 THEN NULL ELSE concat('  ', replace(n_name, '_', '   '), ' ') END AS area_name,
  lpad(cast(l_suppkey % 100 AS VARCHAR), 4, '0') AS rpt_dist_no,
  CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '3' END AS part_1_2,
  split_part('{",".join(map(str, CODE_BY_SIZE))}', ',', p_size) AS crm_cd,
  CASE WHEN l_partkey % 301 = 0 THEN NULL
       ELSE concat(p_type, '  TYPE ', cast(p_size AS VARCHAR),
                   CASE WHEN l_partkey % 97 = 0 THEN ' (RARE)' ELSE '' END) END AS crm_cd_desc,
  CASE WHEN l_orderkey % 13 = 0 THEN 'n/a' ELSE cast((l_partkey + l_orderkey) % 130 - 5 AS VARCHAR) END AS vict_age,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 'X'
       WHEN l_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS vict_sex,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN ' '
       ELSE substr('ABCHW', cast(1 + l_orderkey % 5 AS INTEGER), 1) END AS vict_descent,
  CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE p_brand END AS premis_desc,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'UNKNOWN WEAPON/OTHER WEAPON' WHEN 3 THEN 'HAND  GUN'
       WHEN 4 THEN 'KNIFE' ELSE concat('STRONG-ARM ', cast(l_linenumber AS VARCHAR)) END AS weapon_desc,
  CASE WHEN l_linestatus = 'O' THEN 'Invest Cont' ELSE NULL END AS status_desc,
  CASE WHEN l_suppkey % 10 = 9 THEN '0' WHEN l_suppkey % 10 = 8 THEN NULL WHEN l_suppkey % 10 = 7 THEN '95.5'
       ELSE concat('34.', lpad(cast(l_suppkey % 60 AS VARCHAR), 2, '0')) END AS lat,
  CASE WHEN l_suppkey % 10 = 9 THEN '0'
       ELSE concat('-118.', lpad(cast(l_orderkey % 50 AS VARCHAR), 2, '0')) END AS lon,
  DATE '2024-01-01' AS ingest_date,
  cast(DATE '2000-01-01' + cast(l_partkey AS INTEGER) AS TIMESTAMP) AS processing_datetime
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
)"""

SILVER = f"""
silver_typed AS (
 SELECT *,
  CAST(floor(time_occ_int / 100) AS BIGINT) AS hour_occ,
  time_occ_int % 100 AS minute_occ
 FROM (
  SELECT
   dr_no,
   try_cast(date_rptd AS TIMESTAMP) AS date_reported,
   try_cast(date_occ AS TIMESTAMP) AS date_occ,
   try_cast(time_occ AS INTEGER) AS time_occ_int,
   area AS area_id, area_name, rpt_dist_no AS reporting_district, part_1_2,
   crm_cd AS crime_code, crm_cd_desc AS crime_description,
   CASE WHEN try_cast(vict_age AS INTEGER) > 0 AND try_cast(vict_age AS INTEGER) < 120
        THEN try_cast(vict_age AS INTEGER) END AS victim_age,
   CASE WHEN vict_sex IN ('M', 'F') THEN vict_sex ELSE 'Unknown' END AS victim_sex,
   coalesce(vict_descent, 'Unknown') AS victim_descent,
   coalesce(premis_desc, 'Unknown') AS premise_description,
   coalesce(weapon_desc, {quote(codes.NO_WEAPON_DEFAULT)}) AS weapon_description,
   coalesce(status_desc, 'Unknown') AS status_description,
   try_cast(lat AS DOUBLE) AS lat, try_cast(lon AS DOUBLE) AS lon,
   ingest_date, processing_datetime
  FROM bronze) t
),
silver AS (
 SELECT dr_no, date_occ, hour_occ, minute_occ,
  CAST(year(date_occ) AS INTEGER) AS year, CAST(month(date_occ) AS INTEGER) AS month,
  strftime(date_occ, '%a') AS weekday,
  area_id, area_name, reporting_district, crime_code, crime_description,
  CASE part_1_2 WHEN '1' THEN 'Violent' WHEN '2' THEN 'Non-Violent' ELSE 'Other' END AS crime_category,
  victim_age, victim_sex, victim_descent, premise_description, weapon_description, status_description,
  lat, lon,
  CAST(date_diff('day', CAST(date_occ AS DATE), CAST(date_reported AS DATE)) AS INTEGER) AS reporting_delay_days,
  ingest_date, processing_datetime
 FROM silver_typed
 WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0)
)"""

_NO_WEAPON = ", ".join(quote(v) for v in codes.NO_WEAPON_LABELS)
_TIE = ", ".join(f"{c} ASC NULLS LAST" for c in schemas.GOLD_COLUMNS
                 if c not in ("dr_no", "processing_datetime"))

GOLD = f"""
gold_norm AS (
 SELECT
  {_norm('dr_no')} AS dr_no, date_occ, hour_occ, minute_occ,
  {_norm('area_id')} AS area_id, {_norm('area_name')} AS area_name,
  {_norm('reporting_district')} AS reporting_district, {_norm('crime_code')} AS crime_code,
  {_norm('crime_description')} AS crime_description, {_norm('crime_category')} AS crime_category,
  CASE WHEN victim_age < 0 OR victim_age > 110 THEN NULL ELSE victim_age END AS victim_age,
  {_norm('victim_sex')} AS victim_sex, {_norm('victim_descent')} AS victim_descent,
  {_norm('premise_description')} AS premise_description,
  {_norm('weapon_description')} AS weapon_description,
  {_norm('status_description')} AS status_description,
  CASE WHEN lat < -90 OR lat > 90 THEN NULL ELSE lat END AS lat,
  CASE WHEN lon < -180 OR lon > 180 THEN NULL ELSE lon END AS lon,
  CASE WHEN reporting_delay_days < 0 THEN NULL ELSE reporting_delay_days END AS reporting_delay_days,
  CASE WHEN date_occ IS NOT NULL AND hour_occ BETWEEN 0 AND 23 AND minute_occ BETWEEN 0 AND 59
       THEN CAST(CAST(date_occ AS DATE) AS TIMESTAMP) + to_hours(CAST(hour_occ AS INTEGER)) + to_minutes(minute_occ)
  END AS occurrence_ts,
  ingest_date, processing_datetime
 FROM silver
),
gold_pre AS (
 SELECT dr_no, date_occ, hour_occ, minute_occ, occurrence_ts,
  CAST(occurrence_ts AS DATE) AS occurrence_date,
  CAST(year(occurrence_ts) AS INTEGER) AS year, CAST(month(occurrence_ts) AS INTEGER) AS month,
  strftime(occurrence_ts, '%a') AS weekday,
  area_id, area_name, reporting_district, crime_code, crime_description, crime_category,
  crime_category = 'Violent' AS is_violent,
  victim_age,
  CASE WHEN victim_age IS NULL THEN 'Unknown' WHEN victim_age <= 17 THEN 'Child'
       WHEN victim_age <= 25 THEN 'YoungAdult' WHEN victim_age <= 64 THEN 'Adult' ELSE 'Senior' END
   AS victim_age_group,
  victim_sex, victim_descent, premise_description, weapon_description,
  NOT (lower(weapon_description) IN ({_NO_WEAPON})) AS has_weapon,
  status_description, lat, lon, reporting_delay_days,
  reporting_delay_days > 7 AS is_reported_late,
  ingest_date, processing_datetime
 FROM gold_norm
),
fact AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY dr_no
     ORDER BY processing_datetime DESC NULLS LAST, {_TIE}) AS rn
  FROM gold_pre) t
 WHERE rn = 1
)"""


def _macro_case(code: str = "crime_code") -> str:
    parts = []
    for lbl, values in codes.MACRO_CATEGORIES:
        parts.append(f"WHEN try_cast({code} AS INTEGER) IN ({', '.join(map(str, values))}) THEN {quote(lbl)}")
    return "CASE " + " ".join(parts) + f" ELSE {quote(codes.MACRO_OTHER)} END"


MACRO = f"""
fact_macro AS (
 SELECT *, {_macro_case()} AS macro_category FROM fact
)"""

MART_DAILY = """
mart_daily_area AS (
 SELECT occurrence_date, area_id, area_name,
  count(*) AS crime_count,
  CAST(sum(CAST(is_violent AS INTEGER)) AS BIGINT) AS violent_count,
  avg(reporting_delay_days) AS avg_reporting_delay_days,
  quantile_cont(reporting_delay_days, 0.5) AS median_reporting_delay_days,
  CAST(sum(CAST(is_violent AS INTEGER)) AS DOUBLE) / count(*) AS violent_share
 FROM fact GROUP BY occurrence_date, area_id, area_name
)"""

PREFIX = ",".join([BRONZE, SILVER, GOLD, MACRO, MART_DAILY])


def with_prefix(tail: str, extra_ctes: str = "") -> str:
    """``WITH <shared prefix>[, extra CTEs] <tail>``."""
    ctes = PREFIX + ("," + extra_ctes if extra_ctes.strip() else "")
    return f"WITH {ctes}\n{tail}"


#: the bronze layer and the batches that follow it (``adapter.later_batches``)
_OKEY = "cast(split_part(dr_no, '-', 1) AS BIGINT)"
BATCHES = BRONZE.replace("bronze AS (", "base AS (", 1) + f""",
bronze AS (
 SELECT * FROM base
 UNION ALL SELECT * REPLACE (processing_datetime + INTERVAL 10 DAY AS processing_datetime, '1' AS part_1_2,
   {_pad(f'cast({_OKEY} % 21 AS VARCHAR)', 2)} AS area,
   substr(date_occ, 1, 8) || '15T00:00:00.000' AS date_occ,
   '34.5' AS lat, '-118.25' AS lon)
  FROM base WHERE {_OKEY} % 7 = 0
 UNION ALL SELECT * REPLACE (processing_datetime - INTERVAL 10 DAY AS processing_datetime, 'LATE' AS crm_cd_desc,
   '34.5' AS lat, '-118.25' AS lon) FROM base WHERE {_OKEY} % 11 = 0
 UNION ALL SELECT * REPLACE ('AXE' AS weapon_desc, '05' AS area) FROM base WHERE {_OKEY} % 13 = 0
)"""


def with_batches(tail: str) -> str:
    """As ``with_prefix``, over the bronze layer and all batches."""
    return f"WITH {','.join([BATCHES, SILVER, GOLD, MART_DAILY])}\n{tail}"
