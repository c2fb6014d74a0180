"""Batches merged into the fact and the marts equal a rebuild from all records."""

import random

import pytest
from pyspark.sql import functions as F

from blotter.operators import clean, marts, model
from blotter.plans import upsert
from blotter.sources import schemas, snapshots
from blotter.streaming import incremental
from conftest import bronze_rows, rec, scratch


def batch(spark, rows):
    """Rows with a version time in seconds under ``at``."""
    df = bronze_rows(spark, [{k: v for k, v in r.items() if k != "at"} for r in rows])
    timed = [(*r, row["at"]) for r, row in zip(df.drop("processing_datetime").collect(), rows)]
    timed = spark.createDataFrame(timed, schemas.T.StructType([*df.drop("processing_datetime").schema, schemas.T.StructField("at", schemas.L)]))
    return (timed.withColumn("processing_datetime", F.timestamp_seconds("at"))
            .withColumn("extra", F.lit(None).cast("variant")).select(*schemas.BRONZE.fieldNames()))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def rebuilt(batches):
    every = batches[0]
    for b in batches[1:]:
        every = every.unionByName(b)
    return model.gold(clean.silver(every))


def random_rows(rnd, ids, n, at):
    return [rec(dr_no=rnd.choice(ids), area=rnd.choice(["01", "02", None]), part_1_2=rnd.choice("123"), time_occ=rnd.choice(["1230", "0005", "2400", None]),
                date_occ=f"20{rnd.randrange(18, 22)}-0{rnd.randrange(1, 9)}-01T00:00:00.000" if rnd.random() < 0.95 else None,
                date_rptd=f"2022-01-{rnd.randrange(10, 28)}T00:00:00.000", lat=rnd.choice(["34.5", "34.5", "0", None]), lon=rnd.choice(["-118", "0"]),
                at=at + rnd.choice([-3, 0, 0, 2])) for _ in range(n)]


def check(spark, root, batches):
    now = snapshots.newest(spark, root)
    want = rebuilt(batches)
    got = upsert.fact(spark, now)
    assert same(got, want)
    for name, build in marts.MARTS.items():
        written, plain = now.read(spark, f"gold/{name}"), build(got)
        cols = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
        assert same(written.select(*cols), plain.select(*cols)), name
    return now


def test_batches_equal_a_rebuild(spark, monkeypatch):
    monkeypatch.setattr(upsert, "MOST_PARTS", 3)
    rnd, root = random.Random(6), scratch(spark, "upsert-")
    ids = [str(i) for i in range(60)] + [None]
    batches = [batch(spark, random_rows(rnd, ids[20 * i:20 * i + 30] + ids[-1:], 60, 1000 + i)) for i in range(4)]
    for i, b in enumerate(batches):
        upsert.apply_batch(spark, b, root, buckets=4)
        now = check(spark, root, batches[:i + 1]) if i in (1, 3) else snapshots.newest(spark, root)
        held = now.read(spark, upsert.PARTS).groupBy("bucket").count().agg(F.max("count")).first()[0]
        assert held <= 4
    before = upsert.fact(spark, now).collect()
    again = upsert.apply_batch(spark, batches[1], root)  # a batch that is run again changes nothing
    assert same(upsert.fact(spark, again), spark.createDataFrame(before, schemas.GOLD))


def test_only_touched_parts_are_read(spark):
    root = scratch(spark, "parts-")
    first = upsert.apply_batch(spark, batch(spark, [rec(dr_no=f"a{i}", at=10) for i in range(200)]), root, buckets=8)
    assert len(first.tables[upsert.FACT]) == 8 and first.notes["touched"] == []
    one = upsert.apply_batch(spark, batch(spark, [rec(dr_no="a7", area="09", at=20)]), root)
    (part,) = one.notes["touched"]
    kept = set(first.tables[upsert.FACT]) - {part}
    assert kept < set(one.tables[upsert.FACT]) and len(one.tables[upsert.FACT]) == 8
    assert upsert.fact(spark, one).where("dr_no = 'a7'").first().area_id == "09" and upsert.fact(spark, one).count() == 200
    late = upsert.apply_batch(spark, batch(spark, [rec(dr_no="a7", area="11", at=5)]), root)
    assert upsert.fact(spark, late).where("dr_no = 'a7'").first().area_id == "09"
    new = upsert.apply_batch(spark, batch(spark, [rec(dr_no=f"b{i}", at=10) for i in range(3)]), root)
    assert len(new.notes["touched"]) <= 1  # unknown ids touch no part, but for what a filter mistakes
    assert upsert.fact(spark, new).count() == 203
    assert upsert.fact(spark, first).count() == 200 and upsert.fact(spark, first).where("area_id = '09'").count() == 0
    plan = upsert.fact(spark, new).where("year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_filters_miss_no_id(spark):
    ids = spark.range(3000).select(F.col("id").cast("string").alias("dr_no")).select(*upsert._hashes()).toPandas()
    filter_ = upsert.bloom(ids[:1000])
    assert upsert.known(ids[:1000], filter_).all() and upsert.known(ids[1000:], filter_).mean() < 0.05
    assert not upsert.known(ids, upsert.bloom(ids[:0])).any()


def test_two_writers_and_empty_batches(spark):
    root = scratch(spark, "upsert2-")
    none = batch(spark, [rec(dr_no="1", at=1)]).limit(0)
    now = upsert.apply_batch(spark, none, root)
    assert upsert.fact(spark, now).count() == 0 and now.read(spark, "gold/mart_crime_daily_area").count() == 0
    upsert.apply_batch(spark, batch(spark, [rec(dr_no="1", at=1)]), root)
    slow = snapshots.Transaction(spark, root)
    slow.write(slow.read(upsert.PARTS, upsert.PART), upsert.PARTS)
    upsert.apply_batch(spark, batch(spark, [rec(dr_no="2", at=1)]), root)
    with pytest.raises(snapshots.Conflict):
        slow.commit()
    assert upsert.fact(spark, snapshots.newest(spark, root)).count() == 2


def test_batches_from_a_stream(spark):
    src, root = scratch(spark, "stream-"), scratch(spark, "stream-lake-")
    for i, version in enumerate(("a", "b")):
        with open(f"{src}/page{i}.json", "w") as f:
            f.write('{"dr_no": "1", "date_occ": "2020-01-01T00:00:00.000", "lat": "34", "lon": "-118", "crm_cd": "%s"}\n' % version)
            f.write('{"dr_no": "n%d", "date_occ": "2020-01-01T00:00:00.000", "lat": "34", "lon": "-118"}\n' % i)
        incremental.start_fact_refresh(spark, src, root, run_ts=f"2024-01-0{i + 1} 00:00:00").awaitTermination()
    now = snapshots.newest(spark, root)
    assert sorted((r.dr_no, r.crime_code) for r in upsert.fact(spark, now).collect()) == [("1", "b"), ("n0", None), ("n1", None)]
    assert now.number == 2


def test_merge_moves_rows_once(spark):
    """Old rows and batch meet in one shuffle, which the new parts are written from; no row is sorted before it."""
    old = model.gold(clean.silver(batch(spark, [rec(dr_no=f"a{i}", at=10) for i in range(40)] + [rec(dr_no=None, at=10)]))).localCheckpoint()
    late = model.gold(clean.silver(batch(spark, [rec(dr_no=f"a{i}", area="09", at=9 + i % 3) for i in range(20, 60)]
                                         + [rec(dr_no=None, area="09", at=11)]))).localCheckpoint()
    for pieces in (1, 3):
        out = upsert.merged(old, late, 4, pieces)
        assert same(out.select(*schemas.GOLD_COLUMNS), model.dedup_latest(old.unionByName(late)))
        assert same(out.select("bucket"), out.select(upsert.bucket_of(F.col("dr_no"), 4)))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" not in plan


def test_first_batch_is_written_without_staging(spark, monkeypatch):
    written = []
    write = snapshots.Transaction.write_folder
    monkeypatch.setattr(snapshots.Transaction, "write_folder",
                        lambda t, df, table, *a, **k: written.append(table) or write(t, df, table, *a, **k))
    now = upsert.apply_batch(spark, batch(spark, [rec(dr_no="1", at=1), rec(dr_no="1", area="09", at=2)]), scratch(spark, "first-"))
    assert "gold/batch" not in written and [r.area_id for r in upsert.fact(spark, now).collect()] == ["09"]


def test_marts_of_the_last_batch_count_those_before(spark):
    root = scratch(spark, "marts-")
    batches = [batch(spark, [rec(dr_no=str(i), area=a, at=at) for i in range(n, n + 6)]) for n, a, at in ((0, "01", 1), (3, "02", 2))]
    first = upsert.apply_batch(spark, batches[0], root, buckets=2, write_marts=False)
    with pytest.raises(FileNotFoundError):
        first.read(spark, "gold/mart_crime_daily_area")
    upsert.apply_batch(spark, batches[1], root)
    check(spark, root, batches)
