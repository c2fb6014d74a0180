"""Gold: silver -> analytics-ready fact, plus latest-version de-duplication.

``model`` is one projection (text normalisation, sanity nulls, occurrence
timestamp, calendar parts, flags, age groups) – no shuffle.

``dedup_latest`` keeps one row per ``dr_no``: the latest
``processing_datetime`` wins, nulls lose, and ties fall back to a fixed order
over every other column so the survivor never depends on input order. The
``row_number() = 1`` filter is planned as a partial ``WindowGroupLimit`` before
the shuffle on ``dr_no``, so even a hot id sends at most one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C
from ..sources import schemas

# ``victim_sex`` and ``crime_category`` hold only the labels that silver gives them.
NORMALISED_TEXT = [
    "dr_no", "area_id", "area_name", "reporting_district", "crime_code",
    "crime_description", "victim_descent", "premise_description",
    "weapon_description", "status_description",
]


def model(silver: DataFrame) -> DataFrame:
    """Silver -> gold fact columns (30, fixed order), before de-duplication."""
    df = silver.withColumns({c: C.norm_text(c) for c in NORMALISED_TEXT})
    df = df.withColumns({
        "victim_age": C.null_outside("victim_age", 0, 110),
        "lat": C.null_outside("lat", -90, 90),
        "lon": C.null_outside("lon", -180, 180),
        "reporting_delay_days": C.null_outside("reporting_delay_days", 0, None),
        "occurrence_ts": C.occurrence_ts("date_occ", "hour_occ", "minute_occ"),
    })
    ts = F.col("occurrence_ts")
    df = df.withColumns({
        "occurrence_date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "weekday": C.weekday_short(ts),
        "is_violent": F.col("crime_category") == F.lit(codes.VIOLENT),
        "has_weapon": C.has_weapon("weapon_description"),
        "victim_age_group": C.victim_age_group("victim_age"),
        "is_reported_late": F.col("reporting_delay_days") > F.lit(codes.LATE_REPORT_DAYS),
    })
    return df.select(*schemas.GOLD_COLUMNS)


def dedup_order(columns: list[str], key: str = "dr_no",
                version: str = "processing_datetime") -> list:
    """Latest version first (nulls last), then every other column ascending."""
    rest = [F.col(c).asc_nulls_last() for c in columns if c not in (key, version)]
    return [F.col(version).desc_nulls_last(), *rest]


def dedup_latest(df: DataFrame, key: str = "dr_no",
                 version: str = "processing_datetime") -> DataFrame:
    w = Window.partitionBy(key).orderBy(*dedup_order(df.columns, key, version))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def gold(silver: DataFrame) -> DataFrame:
    """Silver -> de-duplicated gold fact."""
    return dedup_latest(model(silver))
