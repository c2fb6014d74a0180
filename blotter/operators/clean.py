"""Silver: bronze text records -> typed, cleaned incidents.

``typed`` is everything before the geo filter (the data-quality pass counts on
it); ``silver`` adds the filter, calendar parts, category and delay and fixes
the 24-column projection. All steps are narrow projections that Catalyst
collapses into one whole-stage-codegen span over the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C
from ..sources import schemas

# Bronze key -> working name.
RENAME = {
    "dr_no": "dr_no",
    "date_rptd": "date_reported_raw",
    "date_occ": "date_occ_raw",
    "time_occ": "time_occ_raw",
    "area": "area_id",
    "area_name": "area_name",
    "rpt_dist_no": "reporting_district",
    "part_1_2": "part_1_2",
    "crm_cd": "crime_code",
    "crm_cd_desc": "crime_description",
    "vict_age": "victim_age_raw",
    "vict_sex": "victim_sex_raw",
    "vict_descent": "victim_descent_raw",
    "premis_desc": "premise_description_raw",
    "weapon_desc": "weapon_description_raw",
    "status_desc": "status_description_raw",
    "lat": "lat_raw",
    "lon": "lon_raw",
    "ingest_date": "ingest_date",
    "processing_datetime": "processing_datetime",
}


def typed(bronze: DataFrame) -> DataFrame:
    """Rename, parse and default every column; no row is dropped yet."""
    df = bronze.select(*[F.col(src).alias(dst) for src, dst in RENAME.items()])
    time_int = C.try_int("time_occ_raw")
    return df.select(
        "*",
        C.parse_ts("date_reported_raw").alias("date_reported"),
        C.parse_ts("date_occ_raw").alias("date_occ"),
        time_int.alias("time_occ_int"),
        C.hour_of_hhmm(time_int).alias("hour_occ"),
        C.minute_of_hhmm(time_int).alias("minute_occ"),
        C.victim_age_raw("victim_age_raw").alias("victim_age"),
        C.victim_sex("victim_sex_raw").alias("victim_sex"),
        C.default_if_null("victim_descent_raw", codes.UNKNOWN).alias("victim_descent"),
        C.default_if_null("premise_description_raw", codes.UNKNOWN).alias("premise_description"),
        C.default_if_null("weapon_description_raw", codes.NO_WEAPON_DEFAULT).alias("weapon_description"),
        C.default_if_null("status_description_raw", codes.UNKNOWN).alias("status_description"),
        C.try_double("lat_raw").alias("lat"),
        C.try_double("lon_raw").alias("lon"),
    )


def silver_from_typed(df: DataFrame) -> DataFrame:
    d = F.col("date_occ")
    return (
        df.where(C.geo_valid("lat", "lon"))
          .withColumns({
              "year": F.year(d),
              "month": F.month(d),
              "weekday": C.weekday_short(d),
              "crime_category": C.crime_category("part_1_2"),
              "reporting_delay_days": F.datediff(F.col("date_reported"), d),
          })
          .select(*schemas.SILVER_COLUMNS)
    )


def silver(bronze: DataFrame) -> DataFrame:
    """Bronze -> silver (24 columns)."""
    return silver_from_typed(typed(bronze))
