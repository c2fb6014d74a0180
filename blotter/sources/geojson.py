"""Area polygons from GeoJSON FeatureCollections.

``read_area_features`` reads collection files of any layout and derives the join key and label.
``split_features`` cuts collections into their features with many tasks a file, however long
its lines are. Files are read in pieces that end at a closing brace, and every block of a file is
looked at by itself: whether it begins inside a string and how deep in brackets follows from
the quotes and brackets of the blocks before, which a first pass counts for both cases (one
small row a block, on the driver). A second pass then emits each whole feature, and the ends of those
that run over a border between blocks, which are put together.

``multi_line=False`` reads files that hold one collection on each line, a collection in a task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import shared_dir
from . import landing, schemas

_MARK = re.compile(r'\\.|["{}\[\]]', re.S)
#: depth of the brackets around a feature: the collection and its list
_AROUND = 2
#: features handed on at once
ROWS = 500


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, block, texts) of the blocks of a partition; a block's rows stand in a row. The
    brace at which a row was cut is put back."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    it, ahead = rows(), []

    def block(file, start, text):
        yield text + "}"
        for f, s, t in it:
            if (f, s) != (file, start):
                ahead.append((f, s, t))
                return
            yield t + "}"

    for first in it:
        ahead.append(first)
        while ahead:
            file, start, text = ahead.pop()
            texts = block(file, start, text)
            yield file, start, texts
            for _ in texts:
                pass


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotes of a block (odd or even), and its brackets outside strings, if it begins
    outside (d0) or inside (d1) a string."""
    for file, start, texts in _blocks(batches):
        odd, depth = False, [0, 0]
        for text in texts:
            for m in _MARK.findall(text):
                if m == '"':
                    odd = not odd
                elif m in "{[":
                    depth[odd] += 1
                elif m in "}]":
                    depth[odd] -= 1
        yield pa.RecordBatch.from_pylist([{"file": file, "block": start, "odd": odd, "d0": depth[0], "d1": depth[1]}])


def _features(texts: Iterator[str], inside: bool, depth: int) -> Iterator[tuple[int, str]]:
    """(kind, text): 0 the rest of a feature that began in an earlier block, 1 a whole
    feature, 2 the beginning of one that does not end in the block."""
    kind, held = 0, []
    for text in texts:
        begin = 0 if depth > _AROUND else None
        for m in _MARK.finditer(text):
            mark = m.group()
            if mark == '"':
                inside = not inside
            elif inside:
                continue
            elif mark in "{[":
                if depth == _AROUND and mark == "{":
                    kind, begin = 1, m.start()
                depth += 1
            elif mark in "}]":
                depth -= 1
                if depth == _AROUND and begin is not None:
                    yield kind, "".join([*held, text[begin:m.end()]])
                    held, begin = [], None
        if begin is not None:
            held.append(text[begin:])
    if held:
        yield 2 * kind, "".join(held)


def split_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value): the JSON text of each object that stands two brackets deep, line feeds (which no
    JSON string holds) replaced by spaces."""
    pieces = spark.read.option("lineSep", "}").text(paths).select(
        landing.file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    at: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, depth = None, False, 0
    counts = pieces.mapInArrow(_count, "file string, block long, odd boolean, d0 long, d1 long")
    for r in sorted(counts.collect()):  # one small row for each block of a file
        if r["file"] != file:
            file, inside, depth = r["file"], False, 0
        at[r["file"], r["block"]] = inside, depth
        depth += r["d1"] if inside else r["d0"]
        inside ^= r["odd"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, texts in _blocks(batches):
            found = _features(texts, *at[file, start])
            while some := list(islice(found, ROWS)):
                yield pa.RecordBatch.from_pylist([{"file": file, "block": start, "kind": k, "value": v} for k, v in some])

    found = pieces.mapInArrow(run, "file string, block long, kind long, value string")
    parts = found.where("kind <> 1")
    # at most two rows a block: a beginning takes the rests that follow it
    one = F.sum((F.col("kind") == 2).cast("int")).over(Window.partitionBy("file").orderBy("block", "kind"))
    joined = (parts.withColumn("one", one).groupBy("file", "one")
              .agg(F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("texts"))
              .select(F.array_join(F.transform("texts", lambda t: t["value"]), "").alias("value")))
    return (found.where("kind = 1").select("value").unionByName(joined)
            .select(F.translate("value", "\r\n", "  ").alias("value")))


def read_area_features(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """One row per feature: area_id (normalised prec), area_name, geojson, bureau."""
    paths = [path] if isinstance(path, str) else list(path)
    if multi_line:
        # the JSON reader keeps a geometry's text as it stands, so features go through files
        lines = f"{shared_dir(spark)}/blotter-features/{uuid.uuid4().hex}"
        split_features(spark, paths).write.text(lines)
        feats = (spark.read.schema(schemas.GEOJSON_FEATURE).json(lines)
                 .where(F.col("type") == "Feature").select(F.struct("*").alias("f")))
    else:
        fc = spark.read.schema(schemas.GEOJSON_COLLECTION).json(paths)
        feats = fc.select(F.explode("features").alias("f"))
    p = F.col("f.properties")
    return feats.select(
        C.area_key(p.getField("prec")).alias("area_id"),
        C.first_label(p.getField("aprec"), p.getField("name")).alias("area_name"),
        F.col("f.geometry").alias("geojson"),
        p.getField("bureau").alias("bureau"),
    )


def dim_area_geo(features: DataFrame) -> DataFrame:
    """The area dimension: (area_id, area_name, geojson) strings."""
    return features.select(*schemas.DIM_AREA_GEO.fieldNames())
