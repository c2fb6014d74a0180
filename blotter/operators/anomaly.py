"""Trailing-window anomaly detection on daily counts.

The fact is first reduced to one row per day (hash aggregation), so the
ordered window runs over calendar days (a few thousand rows), not incidents.
Pass ``partition_cols`` (e.g. ``["area_id"]``) to score each series in
parallel, or ``block_days`` to score one long series in blocks of so many days.

Semantics: mean and sample std of the *previous* 7 rows (current row
excluded, row-based, only rows with a full window are scored); z = (x - mean)
/ std; anomaly when |z| >= 3. A zero std flags any day that differs from the
mean (its z would be ±inf) and leaves z null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C
from .series import halo_window


def daily_zscore(fact: DataFrame, window: int = codes.ROLLING_DAYS,
                 threshold: float = codes.Z_THRESHOLD,
                 partition_cols: list[str] | None = None, block_days: int | None = None) -> DataFrame:
    keys = list(partition_cols or [])
    daily = (fact.where(F.col("occurrence_date").isNotNull())
                 .groupBy(*keys, "occurrence_date").agg(F.count(F.lit(1)).alias("crime_count")))
    x = F.col("crime_count")

    def measures(w: WindowSpec) -> dict[str, Column]:
        before = w.rowsBetween(-window, -1)
        return {"rolling_mean": F.avg(x).over(before), "rolling_std": F.stddev_samp(x).over(before),
                "_n": F.count(x).over(before)}

    if block_days is None:
        scored = daily.withColumns(measures((Window.partitionBy(*keys) if keys else Window).orderBy("occurrence_date")))
    else:
        block = F.floor(F.unix_date("occurrence_date") / block_days)
        scored = halo_window(daily, "occurrence_date", block, window, measures, keys)
    scored = scored.where(F.col("_n") == window).drop("_n")
    mean, sd = F.col("rolling_mean"), F.col("rolling_std")
    z = F.when(sd > 0, (x - mean) / sd)
    return scored.select(
        *keys, "occurrence_date", "crime_count", "rolling_mean", "rolling_std",
        z.alias("z_score"),
        (F.when(sd > 0, F.abs(z) >= F.lit(threshold)).otherwise(x != mean)).alias("is_anomaly"),
        C.weekday_short("occurrence_date").alias("weekday"),
        F.dayofmonth("occurrence_date").alias("day_of_month"),
    )


def daily_anomalies(fact: DataFrame, **kw) -> DataFrame:
    return daily_zscore(fact, **kw).where(F.col("is_anomaly"))


def _abs_z_sort_key() -> Column:
    # zero-std anomalies have no finite z: rank them first
    return F.coalesce(F.abs(F.col("z_score")), F.lit(float("inf")))


def top_anomalies(fact: DataFrame, n: int = 30, partition_cols: list[str] | None = None,
                  **kw) -> DataFrame:
    """The n anomalies of largest |z|; with ``partition_cols`` over all series, whose keys
    are kept and break ties."""
    keys = list(partition_cols or [])
    return (daily_anomalies(fact, partition_cols=keys, **kw)
            .orderBy(_abs_z_sort_key().desc(), F.col("occurrence_date").asc(),
                     *[F.col(k).asc_nulls_last() for k in keys])
            .limit(n)
            .select(*keys, "occurrence_date", "crime_count", "rolling_mean", "rolling_std", "z_score",
                    "weekday", "day_of_month"))


def _dense_counts(df: DataFrame, column: str, labels: list, name: str) -> DataFrame:
    """Count rows per label for a fixed label list, every label present (0 when none).

    One global conditional aggregation (partial per task, a single row at the end)
    unpivoted to one row per label, in label order: no join, no sort.
    """
    wide = df.agg(*[F.count_if(F.col(column) == F.lit(v)).alias(f"_{i}")
                    for i, v in enumerate(labels)])
    stacked = wide.unpivot([], [f"_{i}" for i in range(len(labels))], "_slot", name)
    slot = F.substring(F.col("_slot"), 2, 4).cast("int")
    label_of = F.element_at(F.array(*[F.lit(v) for v in labels]), slot + 1)
    return stacked.select(label_of.alias(column), F.col(name))


def anomaly_by_weekday(fact: DataFrame, **kw) -> DataFrame:
    """Anomaly days per weekday, Monday first, all 7 present (0 when none)."""
    return _dense_counts(daily_anomalies(fact, **kw), "weekday", codes.WEEKDAYS_SHORT,
                         "anomaly_days")


def anomaly_by_dom(fact: DataFrame, **kw) -> DataFrame:
    """Anomaly days per day of month 1..31 (0 when none)."""
    return _dense_counts(daily_anomalies(fact, **kw), "day_of_month", list(range(1, 32)),
                         "anomaly_days")
