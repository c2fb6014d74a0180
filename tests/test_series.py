"""Trailing windows in blocks, and long lists of types."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from blotter.operators import metrics
from blotter.operators.filters import MOST_LITERALS, Filters, in_types
from blotter.operators.series import halo_window


@pytest.mark.parametrize("before, days", [(1, 1), (2, 3), (7, 5), (7, 40), (3, 1000)])
def test_blocks_equal_the_plain_window(spark, before, days):
    rnd = random.Random(before * days)
    rows = [(k, date(2020, 1, 1) + timedelta(d), rnd.randrange(9)) for k in ("a", "b", None) for d in sorted(rnd.sample(range(400), 60))]
    rows += [("gap", date(2020, 1, 1) + timedelta(d), d) for d in (0, 1, 399)] + [("one", date(2020, 5, 5), 1)]
    df = spark.createDataFrame(rows, "k string, day date, x int")

    def measures(w):
        frame = w.rowsBetween(-before, -1)
        return {"s": F.sum("x").over(frame), "n": F.count("x").over(frame), "own": F.sum("x").over(w.rowsBetween(-before, 0))}

    got = halo_window(df, "day", F.floor(F.unix_date("day") / days), before, measures, ["k"])
    want = df.withColumns(measures(Window.partitionBy("k").orderBy("day")))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = df.where("k = 'a'")
    got = halo_window(one, "day", F.floor(F.unix_date("day") / days), before, measures)
    assert sorted(map(str, got.collect())) == sorted(map(str, one.withColumns(measures(Window.orderBy("day"))).collect()))
    assert halo_window(df.limit(0), "day", F.floor(F.unix_date("day") / days), before, measures).count() == 0


def test_a_series_is_not_one_task(spark):
    df = spark.range(5000).select(F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("day"), F.col("id").alias("x"))
    got = halo_window(df, "day", F.floor(F.unix_date("day") / 100), 7, lambda w: {"s": F.sum("x").over(w.rowsBetween(-7, -1))})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 5000 and len(sizes) > 4 and max(sizes) < 2500


def fact(spark):
    rows = [(f"T{i % 300}", i % 2 == 0, date(2020, 1, 1), 2020) for i in range(1200)] + [(None, True, date(2020, 1, 1), 2020), ("", True, date(2020, 1, 1), 2020)]
    return spark.createDataFrame(rows, "crime_description string, is_violent boolean, occurrence_date date, year int").withColumn("area_id", F.lit("1"))


def test_long_lists_of_types(spark):
    f = fact(spark)
    long = [f"T{i}" for i in range(200, 100_200)]
    assert in_types(f, long).count() == 400 == in_types(f, tuple(long) + (None, "", "T200")).count()
    plan = in_types(f, long)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "T99999" not in plan and " IN (" not in plan
    assert "LeftSemi" not in in_types(f, long[:MOST_LITERALS])._jdf.queryExecution().optimizedPlan().toString()
    table = spark.createDataFrame([("T1",), (None,), ("T1",), ("",)], "any string")
    assert in_types(f, table).count() == 4 and in_types(f, table).columns == f.columns
    assert in_types(f, table.limit(0)).count() == in_types(f, []).count() == in_types(f, [None, ""]).count() == f.count()
    period = ("2020-01-01", "2020-12-31")
    assert metrics.total_incidents(f, Filters(*period, crime_types=tuple(long))).first()[0] == 400
    assert metrics.total_incidents(f, Filters(*period, crime_types=("T1", None, ""))).first()[0] == 4
