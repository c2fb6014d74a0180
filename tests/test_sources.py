"""Nothing is lost on the way in: keys, lines, areas, outputs, versions, changed inputs."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from blotter.operators import anomaly, areas, explore, marts, metrics
from blotter.operators.filters import Filters
from blotter.plans import catalog
from blotter.plans import refresh as R
from blotter.sources import adapter, geojson, landing, schemas
from blotter.streaming import incremental
from conftest import scratch

GOOD = '{"dr_no": "%d", "date_occ": "2020-01-01T00:00:00.000", "lat": "34", "lon": "-118"%s}'


def write(folder, name, text):
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_every_key_survives(spark):
    d = scratch(spark, "keys-")
    write(d, "a.json", GOOD % (1, ', "premise_note": "rear", "n": 5') + "\n" + GOOD % (2, "") + "\n")
    rows = {r.dr_no: r for r in landing.ingest(spark, d, run_ts="2024-01-01 00:00:00").collect()}
    assert rows["1"].extra.toPython() == {"premise_note": "rear", "n": 5} and rows["2"].extra is None


def test_other_keys_keep_their_types(spark):
    d = scratch(spark, "types-")
    write(d, "a.json", GOOD % (1, ', "geo": {"type": "Point", "at": [1, 2.50]}, "ok": true, "none": null, "big": 12345678901234567890') + "\n"
          + GOOD % (2, r', "n\u006fte": "x, \"lat\": {\""') + "\n" + '{"dr_no": 3, "date_occ": "2020-01-01", "lat": 7.10}\n')
    rows = {r.dr_no: r for r in landing.ingest(spark, d).withColumn("json", F.to_json("extra")).collect()}
    assert rows["1"].json == '{"big":12345678901234567890,"geo":{"at":[1,2.5],"type":"Point"},"none":null,"ok":true}'
    assert landing.ingest(spark, d).where("dr_no = '1'").select(F.variant_get("extra", "$.geo.at[0]", "int")).first()[0] == 1
    assert rows["2"].json == r'{"note":"x, \"lat\": {\""}'
    assert rows["3"].lat == "7.1"


LAYOUTS = {
    "comma_last.json": "[" + GOOD % (1, "") + ",\n" + GOOD % (2, ', "z": {"q": [1]}') + ",\n" + GOOD % (3, "") + "]\n",
    "comma_first.json": "[" + GOOD % (4, "") + "\n," + GOOD % (5, ', "z": {"q": [1]}') + "\n  , " + GOOD % (6, "") + "]",
    "one_line.json": "[" + GOOD % (7, "") + ", " + GOOD % (8, ', "z": {"q": [1]}') + "," + GOOD % (9, "") + "]",
    "pretty.json": "[\n" + ",\n".join((GOOD % (i, x)).replace(", ", ",\n  ").replace("{", "{\n  ").replace("}", "\n}")
                                       for i, x in ((10, ""), (11, ', "z": {"q": [1]}'), (12, ""))) + "\n]\n",
    "pretty_lines.json": "\ufeff" + "\n".join((GOOD % (i, "")).replace(", ", ",\n  ") for i in (13, 14)) + "\n",
    "brackets.json": "[\n" + GOOD % (15, "") + "\n,\n" + GOOD % (16, "") + "\n]\n",
}


def test_all_layouts_give_the_same_rows(spark):
    d = scratch(spark, "layouts-")
    for name, text in LAYOUTS.items():
        write(d, name, text)
    assert sorted(p.rsplit("/", 1)[1] for p in landing.spread_files(spark.read.text(d))) == ["pretty.json", "pretty_lines.json"]
    raw = landing.read_landing(spark, d)
    rows = {int(r.dr_no): r for r in raw.withColumn("json", F.to_json("extra")).collect()}
    assert sorted(rows) == list(range(1, 17)) and raw.count() == 16
    assert {i for i, r in rows.items() if r.json == '{"z":{"q":[1]}}'} == {2, 5, 8, 11}
    assert {(r.date_occ, r.lat, r.corrupt_record) for r in rows.values()} == {("2020-01-01T00:00:00.000", "34", None)}
    assert sorted(int(r.dr_no) for r in landing.read_landing(spark, d, layout="pages").collect()) == list(range(1, 17))
    with pytest.raises(ValueError):
        landing.read_landing(spark, d, layout="xml")


def test_odd_records(spark):
    d = scratch(spark, "odd-")
    write(d, "a.json", '{"z": 1}\n{"dr_no": null}\n[{"dr_no": "3"}, 17, {"dr_no": "4"}]\n{"dr_no": "5", "z": 1, "z": 2}\n[[1]]\n"x"\n'
          + GOOD % (6, ', "k": "' + "\\n" * 20000 + '"') + "\n")
    raw = landing.read_landing(spark, d)
    p = landing.profile(raw).first()
    assert (p.records, p.corrupt_lines, p.records_with_extra) == (6, 4, 2)
    assert sorted(str(r.dr_no) for r in raw.where("corrupt_record is null").collect()) == ["3", "4", "5", "6", "None", "None"]


def test_skip_index(spark):
    d, root = scratch(spark, "zones-"), scratch(spark, "lake-")
    index = f"{root}/landing/index"
    at = GOOD.replace("2020", "%d")
    for year in (2018, 2019, 2020):
        write(d, f"{year}+a b.json", "\n".join(at % (year * 10 + i, year, "") for i in range(3)) + "\nnot a record\n")
    write(d, "none.json", '{"dr_no": "1"}\n')
    write(d, "empty.json", "")
    rows = {r.path.rsplit("/", 1)[1]: r for r in landing.update_index(spark, d, index).collect()}
    assert len(rows) == 4 and rows["2019+a b.json"][3:] == ("2019-01-01T00:00:00.000", "2019-01-01T00:00:00.000", 3, 1)
    assert rows["none.json"].last_date is None

    def read(**kw):
        df = landing.ingest(spark, d, year_from=2019, run_ts="2024-01-01 00:00:00", **kw)
        return sorted(r.dr_no for r in df.collect()), {p.rsplit("/", 1)[1] for p in df.inputFiles()}

    plain, everything = read()
    got, files = read(index=index)
    assert got == plain and len(got) == 6 and len(everything) == 5 and files == {"2019+a%20b.json", "2020+a%20b.json"}
    write(d, "late.json", at % (7, 2021, "") + "\n")  # not indexed: read
    write(d, "2018+a b.json", at % (8, 2022, "") + "\n")  # changed: read
    got, files = read(index=index)
    assert got == read()[0] and {"7", "8"} < set(got) and len(files) == 4
    before = landing.versions(spark, index)
    rows = {r.path.rsplit("/", 1)[1]: r for r in landing.update_index(spark, d, index).collect()}
    assert len(rows) == 5 and rows["2018+a b.json"].last_date.startswith("2022") and len(landing.versions(spark, index)) == len(before) + 1
    assert read(index=index)[0] == read()[0]
    assert landing.ingest(spark, d, year_from=2050, index=index).count() == 0
    assert read(index=f"{root}/landing/missing")[0] == read()[0]


def test_records_beside_empty_elements_of_a_page(spark):
    d = scratch(spark, "holes-")
    page = "[" + GOOD % (1, "") + ", {}, null, " + GOOD % (2, "") + "]"
    write(d, "page.json", page + "\n" + GOOD % (3, "") + "\n[{}, null]\n")
    raw = landing.read_landing(spark, d)
    p = landing.profile(raw).first()
    assert (p.records, p.corrupt_lines) == (3, 2)
    assert sorted(r.dr_no for r in landing.ingest(spark, d).collect()) == ["1", "2", "3"]
    assert {r.corrupt_record for r in raw.where("corrupt_record is not null").collect()} == {page, "[{}, null]"}


def test_array_pages_and_corrupt_lines(spark):
    d = scratch(spark, "pages-")
    write(d, "lines.json", "[\n" + GOOD % (1, "") + ",\n" + GOOD % (2, "") + "\n]\n")
    write(d, "one.json", "[" + GOOD % (3, "") + ", " + GOOD % (4, "") + "]")
    write(d, "dense.json", "[" + GOOD % (5, "") + ",\n" + GOOD % (6, ', "note": "a, [b]"') + "]\n")
    write(d, "bad.json", GOOD % (7, "") + '\n{"dr_no": "8", "date_\nnot a record\n[]\n\n17\n{}\n')
    raw = landing.read_landing(spark, d)
    p = landing.profile(raw).first()
    assert (p.records, p.corrupt_lines, p.records_with_extra) == (7, 4, 1)
    assert {r.dr_no for r in landing.ingest(spark, d).collect()} == {str(i) for i in range(1, 8)}
    assert raw.where("corrupt_record = 'not a record'").count() == 1
    assert raw.where("dr_no = '6'").first().extra.toPython() == {"note": "a, [b]"}


def test_one_landing_folder_fills_two_outputs(spark):
    d, one, two = (scratch(spark, p) for p in ("in-", "one-", "two-"))
    write(d, "a.json", GOOD % (1, "") + "\n")
    for out in (one, two, one):
        incremental.start_silver_refresh(spark, d, f"{out}/silver", run_ts="2024-01-01 00:00:00").awaitTermination()
    assert [spark.read.parquet(f"{o}/silver").count() for o in (one, two)] == [1, 1]


def test_long_area_keys_stay_whole(spark):
    assert spark.range(1).select(adapter._lpad(F.lit(102), 2), adapter._lpad(F.lit(7), 2)).first()[:] == ("102", "07")
    fact = fact_of(spark, [dict(area_id="102", area_name="NEW"), dict(area_id="22"), dict(area_id="X1"), dict(area_id="06")])
    d = scratch(spark, "areas-")
    adapter.area_collections(fact).write.mode("overwrite").text(d)
    dim = geojson.dim_area_geo(geojson.read_area_features(spark, d, multi_line=False))
    assert {r.area_id for r in dim.collect()} == {"102", "22", "X1", "6"}


def fact_of(spark, rows):
    base = dict.fromkeys(schemas.GOLD_COLUMNS)
    base.update(dr_no="1", occurrence_date=None, hour_occ=1, weekday="Mon", area_id="1", area_name="A", lat=34.0, lon=-118.0,
                crime_category="Violent", is_violent=True)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schemas.GOLD)


@pytest.fixture
def day():
    from datetime import date
    return date(2020, 1, 6)


def test_values_outside_the_lists_are_counted(spark, day):
    f = fact_of(spark, [dict(crime_category="Arson", occurrence_date=day, year=2020, hour_occ=24), dict(crime_category=None),
                        dict(occurrence_date=day, year=2020, hour_occ=None)])
    pivot = explore.hourly_category_pivot(f).collect()
    assert sum(r["Violent"] + r["Other"] + r["Non-Violent"] + r["other_values"] for r in pivot) == 3
    m = metrics.weekday_hour_matrix(f, Filters("2020-01-01", "2020-12-31")).first()
    assert m.h_other == 2


def test_limit_zero_is_empty(spark, day):
    f = fact_of(spark, [dict(occurrence_date=day, year=2020, victim_sex="F")])
    assert metrics.distribution(f, Filters("2020-01-01", "2020-12-31"), "victim_sex", 0).count() == 0


def test_null_flags_in_the_monthly_mart(spark, day):
    f = fact_of(spark, [dict(occurrence_date=day, is_violent=None)])
    assert marts.mart_monthly_area(f).first().violent_count == 0
    assert marts.mart_daily_area(f).first().violent_count is None


def test_two_polygons_of_one_key_do_not_double_a_metric(spark):
    m = spark.createDataFrame([("07", 5), ("8", 1)], "area_id string, crime_count long")
    dim = spark.createDataFrame([("7", "B", "g2"), ("7", "A", "g1"), ("9", "C", "g")], schemas.DIM_AREA_GEO)
    got = {r.area_id: (r.geo_area_name, r.geojson) for r in areas.area_map_geo(m, dim).collect()}
    assert got == {"07": ("A", "g1"), "8": (None, None)}


def test_top_anomalies_keep_their_series(spark, day):
    from datetime import timedelta
    rows = [dict(area_id=a, occurrence_date=day + timedelta(i)) for a in "ab" for i in range(8) for _ in range(9 if i == 7 else 1)]
    top = anomaly.top_anomalies(fact_of(spark, rows), partition_cols=["area_id"]).collect()
    assert [r.area_id for r in top] == ["a", "b"]


def test_layer_versions(spark):
    root = scratch(spark, "versions-")
    a = spark.createDataFrame([(1, "x")], "k int, old string")
    b = spark.createDataFrame([(2, 3.0)], "k int, new double")
    for _ in range(3):
        landing.write_layer(a, root, "bronze", "t")
    assert len(landing.versions(spark, f"{root}/bronze/t")) == landing.KEPT_VERSIONS
    held = landing.read_layer(spark, root, "bronze", "t")
    with pytest.raises(Exception):
        landing.write_layer(a.withColumn("k", F.raise_error(F.lit("stop")).cast("int")), root, "bronze", "t")
    assert landing.read_layer(spark, root, "bronze", "t").collect() == held.collect() == a.collect()
    landing.write_layer(b, root, "bronze", "t", evolve=True)
    assert landing.read_layer(spark, root, "bronze", "t").select("k", "old", "new").collect() == [(2, None, 3.0)]
    assert held.collect() == a.collect()
    landing.write_layer(b, root, "bronze", "t")
    assert landing.read_layer(spark, root, "bronze", "t").columns == ["k", "new"]


def test_queries_follow_a_changed_input(spark, sf_small):
    d = f"{scratch(spark, 'star-')}/sf"
    shutil.copytree(sf_small, d, copy_function=shutil.copyfile)  # the test data is read-only
    os.chmod(d, 0o755)
    assert (before := catalog.QUERIES["fact_span"](spark, d).first().total_incidents) > 0
    li = pq.read_table(f"{sf_small}/lineitem.parquet")
    pq.write_table(li.slice(0, li.num_rows // 2), f"{d}/lineitem.parquet")
    assert 0 < catalog.QUERIES["fact_span"](spark, d).first().total_incidents < before


def test_refresh_checks_the_fact(spark):
    f = fact_of(spark, [dict(dr_no="1"), dict(dr_no="1")])
    with pytest.raises(R.CheckFailed):
        R.check_fact(f)
    assert R.check_fact(f.limit(1))["rows"] == 1
