"""Declared schemas of every layer (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS, LOCAL_TS = T.DateType(), T.TimestampType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw record keys as landed (all text). Keys missing from a record load as null,
# keys not listed here are kept in the VARIANT ``extra``.
BRONZE_RAW_COLUMNS = [
    "dr_no", "date_rptd", "date_occ", "time_occ", "area", "area_name", "rpt_dist_no",
    "part_1_2", "crm_cd", "crm_cd_desc", "vict_age", "vict_sex", "vict_descent",
    "premis_desc", "weapon_desc", "status_desc", "lat", "lon",
]
BRONZE_RAW = _struct(*[(c, S) for c in BRONZE_RAW_COLUMNS])

# Bronze = raw + lineage columns + every other key of the record.
BRONZE = _struct(*[(c, S) for c in BRONZE_RAW_COLUMNS],
                 ("ingest_date", DATE), ("processing_datetime", TS), ("data_source", S),
                 ("extra", T.VariantType()))

# Occurrence dates/times are local wall-clock values (TIMESTAMP_NTZ); the
# processing time is an instant (TIMESTAMP).
SILVER = _struct(
    ("dr_no", S), ("date_occ", LOCAL_TS), ("hour_occ", L), ("minute_occ", I),
    ("year", I), ("month", I), ("weekday", S),
    ("area_id", S), ("area_name", S), ("reporting_district", S),
    ("crime_code", S), ("crime_description", S), ("crime_category", S),
    ("victim_age", I), ("victim_sex", S), ("victim_descent", S),
    ("premise_description", S), ("weapon_description", S), ("status_description", S),
    ("lat", D), ("lon", D), ("reporting_delay_days", I),
    ("ingest_date", DATE), ("processing_datetime", TS),
)
SILVER_COLUMNS = SILVER.fieldNames()

GOLD = _struct(
    ("dr_no", S),
    ("date_occ", LOCAL_TS), ("hour_occ", L), ("minute_occ", I),
    ("occurrence_ts", LOCAL_TS), ("occurrence_date", DATE),
    ("year", I), ("month", I), ("weekday", S),
    ("area_id", S), ("area_name", S), ("reporting_district", S),
    ("crime_code", S), ("crime_description", S), ("crime_category", S), ("is_violent", B),
    ("victim_age", I), ("victim_age_group", S), ("victim_sex", S), ("victim_descent", S),
    ("premise_description", S),
    ("weapon_description", S), ("has_weapon", B),
    ("status_description", S),
    ("lat", D), ("lon", D),
    ("reporting_delay_days", I), ("is_reported_late", B),
    ("ingest_date", DATE), ("processing_datetime", TS),
)
GOLD_COLUMNS = GOLD.fieldNames()

DIM_AREA_GEO = _struct(("area_id", S), ("area_name", S), ("geojson", S))

# GeoJSON FeatureCollection. `geometry` and `prec` are read as STRING: the raw
# JSON text is kept (Polygon and MultiPolygon nest differently) and `7`, `7.0`
# and "07" all load.
GEOJSON_FEATURE = _struct(
    ("type", S),
    ("geometry", S),
    ("properties", _struct(("prec", S), ("aprec", S), ("name", S), ("bureau", S))),
)
GEOJSON_COLLECTION = _struct(("type", S), ("features", T.ArrayType(GEOJSON_FEATURE)))
