"""Collections cut into features by many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from blotter.sources import geojson
from conftest import scratch


def collection(rnd, n):
    odd = ["plain", 'a "quoted" {brace', "back\\slash\\", "]}{[", "é漢🙂", ""]
    return {"type": "FeatureCollection", "name": "x }", "meta": {"a": {"b": [1, {"c": "}"}]}}, "bbox": [1, 2],
            "features": [{"type": "Feature", "properties": {"prec": i, "name": rnd.choice(odd) + str(i), "more": {"q": [{"z": rnd.choice(odd)}]}},
                          "geometry": {"type": "Polygon", "coordinates": [[[rnd.randrange(90), rnd.randrange(90)] for _ in range(rnd.randrange(1, 6))]]}}
                         for i in range(n)],
            "links": [{"rel": "self"}]}


@pytest.mark.parametrize("indent, block", [(None, 64), (None, 1000), (1, 97), (4, 128 << 20)])
def test_blocks_equal_the_whole_file(spark, indent, block):
    d, rnd = scratch(spark, "geo-"), random.Random(block)
    want = []
    for i, n in enumerate((40, 1, 0)):
        c = collection(rnd, n)
        want += c["features"]
        with open(f"{d}/c {i}.geojson", "w") as f:
            json.dump(c, f, indent=indent, ensure_ascii=i == 0)
    with open(f"{d}/lines.geojson", "w") as f:  # collections on lines of their own
        for n in (2, 3):
            c = collection(rnd, n)
            want += c["features"]
            f.write(json.dumps(c) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = [json.loads(r.value) for r in geojson.split_features(spark, [d]).collect()]
        rows = geojson.read_area_features(spark, d).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    key = lambda f: json.dumps(f, sort_keys=True)
    assert sorted(map(key, (f for f in got if f.get("type") == "Feature"))) == sorted(map(key, want))
    assert sorted((r.area_id, r.area_name, json.loads(r.geojson)["coordinates"]) for r in rows) == sorted(
        (str(f["properties"]["prec"]), f["properties"]["name"].strip(), f["geometry"]["coordinates"]) for f in want)


def test_a_large_collection_spreads_over_tasks(spark):
    d = scratch(spark, "geo-large-")
    feature = '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, %d]}, "properties": {"prec": "%d", "name": "n"}}'
    with open(f"{d}/one_line.geojson", "w") as f:
        f.write('{"type": "FeatureCollection", "features": [' + ", ".join(feature % (i, i) for i in range(100_000)) + "]}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        features = geojson.split_features(spark, [d])
        sizes = [r["count"] for r in features.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 100_000 and len(sizes) > 8 and max(sizes) < 20_000
        assert geojson.read_area_features(spark, d).select("area_id").distinct().count() == 100_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
