"""Steps of the written layers: a query's layers are built as far as it reads them."""

import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from blotter import session
from blotter.plans import refresh, upsert
from blotter.sources import files, landing, schemas, snapshots

from conftest import scratch


def _star(spark, d, orders):
    day = datetime.date(1997, 3, 5)
    tables = {
        "lineitem": ([(o, 1, 1, n, "A", "O") for o in orders for n in (1, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_returnflag string, l_linestatus string"),
        "orders": ([(o, day) for o in orders], "o_orderkey long, o_orderdate date"),
        "supplier": ([(1, 3)], "s_suppkey long, s_nationkey long"),
        "nation": ([(3, "CANADA")], "n_nationkey long, n_name string"),
        "part": ([(1, "Brand#1", "TIN", 7)], "p_partkey long, p_brand string, p_type string, p_size long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{d}/{name}.parquet")
    return d


@pytest.fixture
def star(spark):
    return _star(spark, scratch(spark, "star-"), range(1, 9))


def _tables(spark, star):
    return set(snapshots.newest(spark, refresh.layers_root(spark, star)).tables)


def test_batches_are_merged_without_the_layers_they_do_not_read(spark, star):
    now = refresh.upserted(spark, star)
    assert upsert.fact(spark, now).count() == 16
    assert _tables(spark, star) == {refresh.BRONZE}
    assert not files.exists(spark, refresh.Layers(refresh.layers_root(spark, star)).landing_dir)


def test_dashboard_layers_are_built_without_landing_files(spark, star):
    out = refresh.layers(spark, star)
    assert out.fact(spark).count() == 16
    assert not files.exists(spark, out.landing_dir) and not files.exists(spark, out.areas_dir)
    assert {"gold/" + m for m in upsert.MARTS} | {refresh.BRONZE, refresh.SILVER, refresh.FACT} == _tables(spark, star)


def test_landing_files_are_made_without_a_refresh(spark, star):
    out = refresh.layers(spark, star, "landing")
    assert landing.ingest(spark, out.landing_dir).count() == 16
    assert _tables(spark, star) == {refresh.BRONZE}


def test_later_steps_join_those_that_are_there(spark, star):
    bronze = refresh.layers(spark, star, "bronze").now(spark).paths(refresh.BRONZE)
    out = refresh.layers(spark, star, "areas")
    assert out.dim_area_geo(spark).count() == 1
    assert out.now(spark).paths(refresh.BRONZE) == bronze
    refresh.layers(spark, star, "landing")
    assert refresh.layers(spark, star, "areas").now(spark) == out.now(spark)


def test_every_step_runs_again_after_the_inputs_have_changed(spark, star):
    for step in refresh.STEPS:
        refresh.layers(spark, star, step)
    time.sleep(0.01)
    _star(spark, star, range(1, 11))
    assert landing.ingest(spark, refresh.layers(spark, star, "landing").landing_dir).count() == 20
    assert refresh.layers(spark, star).fact(spark).count() == 20
    assert upsert.fact(spark, refresh.upserted(spark, star)).count() == 20


def test_paths_are_decoded_once_a_file(spark):
    d = scratch(spark, "odd names-")
    texts = {"a+b c%20.json": ' ,\t"dr_no": "1",\n', "plain.json": '{"dr_no": "2", "date_occ": "2020"}\n',
             "text.json": 'x "dr_no": "3"\n,"no key"\n'}
    for name, text in texts.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    assert [os.path.basename(p) for p in landing.spread_files(spark.read.text(d))] == ["a+b c%20.json"]
    zones = landing.zones(spark, [d], layout="lines")
    assert {os.path.basename(r["path"]): r["records"] for r in zones.collect()} == {
        "a+b c%20.json": 0, "plain.json": 1, "text.json": 0}
    plan = zones._jdf.queryExecution().optimizedPlan().toString()
    assert "url_decode" in plan.lower() or "UrlCodec" in plan
    below = plan[plan.index("Aggregate"):].split("\n", 1)[1]
    assert "url_decode" not in below.lower() and "UrlCodec" not in below


def test_entry_has_wide_projections_compiled(spark, star):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        for given, then in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(key, given)
            assert entry.queries()["silver_clean"](spark, star).agg(F.count("*")).first()[0] == 16
            assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)


def test_readers_of_the_fact_or_a_mart_build_no_other_layer(spark, star):
    queries = entry.queries()
    assert queries["fact_macro"](spark, star).count() == 16
    assert _tables(spark, star) == {refresh.BRONZE, refresh.FACT}
    notes = snapshots.newest(spark, refresh.layers_root(spark, star)).notes
    assert notes["fact"]["rows"] == 16 and notes["fact"]["null_dr_no"] == 0
    assert queries["area_list"](spark, star).count() == 1
    assert _tables(spark, star) == {refresh.BRONZE, refresh.FACT, "gold/mart_crime_daily_area"}


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _texts(found):
    """Records of a landing read, in which VARIANT values cannot be compared."""
    return found.withColumn("extra", F.to_json("extra"))


def test_steps_in_slices_give_the_rows_of_whole_steps(spark, monkeypatch):
    star = _star(spark, scratch(spark, "sliced-"), [*range(1, 60), *range(1, 60, 7)])  # some ids come twice
    whole = refresh.layers(spark, star, "landing")
    fact, landed = refresh.layers(spark, star, "fact").fact(spark), _texts(landing.read_landing(spark, whole.landing_dir))
    after = refresh.upserted(spark, star)
    wanted = [whole.bronze(spark).drop("extra"), fact, landed, upsert.fact(spark, after), after.read(spark, upsert.STATE)]
    wanted = [spark.createDataFrame(w.collect(), w.schema) for w in wanted]
    refresh._BUILT.clear()
    refresh._UPSERTED.clear()
    monkeypatch.setattr(session, "SLICE_BYTES", 1)
    monkeypatch.setattr(session, "MOST_SLICES", 3)
    out = refresh.layers(spark, star, "landing")
    refresh.layers(spark, star, "fact")
    now = refresh.upserted(spark, star)
    assert len(out.now(spark).tables[refresh.BRONZE]) == len(out.now(spark).tables[refresh.FACT]) == session.MOST_SLICES
    assert len(now.tables[upsert.STATE]) == 1
    got = [out.bronze(spark).drop("extra"), out.fact(spark), _texts(landing.read_landing(spark, out.landing_dir)),
           upsert.fact(spark, now), now.read(spark, upsert.STATE)]
    for a, b in zip(got, wanted):
        assert _same(a.select(b.columns), b)
    assert out.fact(spark).select("dr_no").distinct().count() == out.fact(spark).count()
    assert "PartitionFilters: [isnotnull(year" in out.fact(spark).where("year = 1997")._jdf.queryExecution().toString()


def test_equal_normalised_ids_are_in_one_slice(spark, monkeypatch):
    monkeypatch.setattr(session, "SLICE_BYTES", 1)
    ids = ["a  b", " a b ", "a\tb", None, None]
    bronze = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "dr_no string, n int")
    base = bronze.select("dr_no", *[F.lit({"lat": "34.5", "lon": "-118"}.get(f.name)).cast(f.dataType).alias(f.name)
                                    for f in schemas.BRONZE if f.name != "dr_no"])
    slices = refresh.gold_slices(base, size=1 << 30)
    assert len(slices) == session.MOST_SLICES
    assert sorted((r.dr_no or "") for s in slices for r in s.select("dr_no").collect()) == ["", "a b"]


def test_written_layers_leave_no_shuffle_files_and_no_setting(spark, star):
    key, cleaned = session._CLEANUP, []
    assert spark.conf.get(key, None) is None
    with session.released(spark), session.released(spark):
        cleaned.append(spark.conf.get(key))
    assert cleaned == ["true"] and spark.conf.get(key, None) is None
    spark.conf.set(key, "false")
    try:
        with session.released(spark):
            assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)
    status = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    spark._jvm.System.gc()
    before = set(status.shuffleStatuses().keySet().toList().mkString(",").split(","))
    refresh.layers(spark, star, "fact")
    after = set(status.shuffleStatuses().keySet().toList().mkString(",").split(","))
    assert after <= before


def test_landing_files_are_compressed_and_of_bounded_length(spark, star, monkeypatch):
    monkeypatch.setattr(refresh, "LANDED_LINES", 2)
    out = refresh.layers(spark, star, "landing")
    names = [n for n in files.names(spark, out.landing_dir) if n.startswith("part-")]
    assert names and all(n.endswith(".txt.gz") for n in names)
    lines = spark.read.text(out.landing_dir).groupBy(F.input_file_name()).count()
    assert spark.read.text(out.landing_dir).where("value like '[{%' or value like '  , %'").count() > 0
    assert landing.ingest(spark, out.landing_dir).count() == 16 and lines.count() == len(names)


def test_commits_between_batches_are_removed(spark, star):
    now = refresh.upserted(spark, star)
    held = {f"written={f.split('written=')[1][:20]}" for f in now.tables[upsert.FACT]}
    assert set(files.names(spark, f"{now.root}/{upsert.FACT}")) == held
    assert snapshots.numbers(spark, now.root) == [now.number]
