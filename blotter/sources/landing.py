"""Landing-zone reader and layer writers (bronze/silver/gold as Parquet).

* ``read_landing``  – raw JSON record files: one record per line, or page files that hold
  an array (on one line, with a record on each line, or pretty-printed). Every key survives: the
  declared ones as text columns, all others typed in the VARIANT ``extra``. A line or page that
  holds anything but records gives one row with its text in ``corrupt_record`` besides those
  of its records; ``profile`` counts such rows.
* ``since_year``    – the source-side lower bound on ``date_occ`` as an ISO text
  compare; it is a plain filter on the scan and drops null dates.
* ``with_lineage``  – ``ingest_date`` / ``processing_datetime`` / ``data_source``;
  the run timestamp is an argument so re-runs are repeatable.
* ``write_layer`` / ``read_layer`` – full overwrite of a layer table under a root folder.
  Every write makes a new version (``<root>/<layer>/<table>/<version>``); a version counts
  once its job has committed (``_SUCCESS``), so readers see the last whole table while a
  new one is written, and a failed job changes nothing.
"""

from __future__ import annotations

import re
import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files, schemas

#: versions kept of a layer table: the current one and the one a reader may still hold
KEPT_VERSIONS = 2


#: white space, and what stands between and around the records of an array
_AROUND = " \t\r\n\ufeff,[]"
#: columns of a record that is looked at closely
_KEYS, _SOUND, _WHOLE = " other keys", " is a record", " has all keys"


def _look_closer(declared: list[str]) -> str:
    """Pattern of texts that may hold a key that is not declared, an empty record or a null.
    None is missed; a value that looks like one costs a closer look at its text."""
    names = "|".join(re.escape(c) for c in declared)
    key = rf'"(?!(?:{names})"\s*:)[^"\\]*+(?:\\.[^"\\]*+)*+"\s*:'
    return rf"[{{,\[]\s*(?:{key}|null\s*[,\]]|\{{\s*\}})"


def parse_records(texts: DataFrame, schema: T.StructType = schemas.BRONZE_RAW, pages: bool = False,
                  others: bool = True, carry: list[str] = []) -> DataFrame:
    """Lines or whole pages (column ``value``) -> declared columns, ``extra``, ``corrupt_record``.

    A text may be a record, an array of records, or a line of an array that has a record
    on each line, with the comma at the end of the line or at the start of the next. Declared
    keys are parsed straight to their columns. Only a text that may hold other keys, an empty
    record or anything that is no record is looked at record by record: its other keys become
    the VARIANT ``extra``, in which nested values and numbers keep their type. ``pages`` says
    that texts have several lines; without ``others`` only declared keys are wanted; the
    columns of ``texts`` named in ``carry`` stand beside each record.
    """
    declared = schema.fieldNames()
    inner = F.btrim("value", F.lit(_AROUND))
    if pages:  # records that follow each other without a comma stand on lines of their own
        inner = F.regexp_replace(inner, r"\}[ \t\r]*\n\s*\{", "},{")
    plain = T.StructType([T.StructField(c, T.StringType()) for c in declared])
    record = T.StructType([*plain, T.StructField(_KEYS, T.MapType(T.StringType(), T.VariantType())),
                           T.StructField(_SOUND, T.BooleanType()), T.StructField(_WHOLE, T.BooleanType())])
    held = (texts.where(F.btrim("value", F.lit(_AROUND)) != "")
            .select("value", inner.alias("inner"), *carry))
    # a text of several records is cut first, so that each one is judged by itself
    several = F.lit(True) if pages else F.rlike("inner", F.lit(r"\}\s*,\s*\{"))
    whole = F.from_json(F.concat(F.lit("["), F.col("inner"), F.lit("]")), "array<string>")
    held = held.withColumn("cut", F.when(several, whole)).withColumn(
        "sound", F.filter("cut", lambda x: F.startswith(x, F.lit("{")) & (x != "{}")))
    # the text itself goes only with what is reported as corrupt, not with each of its records
    def unit(text, source):
        return F.struct(text.alias("unit"), source.alias("value"))

    none_text = F.lit(None).cast("string")
    nothing, good = F.array(unit(none_text, F.col("value"))), F.transform("sound", lambda x: unit(x, none_text))
    units = (F.when(~several, F.array(unit(F.col("inner"), F.col("value")))).when(F.col("cut").isNull(), nothing)
             .when(F.size("sound") < F.size("cut"), F.concat(good, nothing)).otherwise(good))
    parsed = (held.select(*carry, F.explode(units).alias("u"))
              .select(*carry, F.coalesce("u.value", "u.unit").alias("value"),
                      F.concat(F.lit("["), F.coalesce("u.unit", F.lit("[")), F.lit("]")).alias("page"))
              .withColumn("records", F.from_json("page", T.ArrayType(record))))
    closer = F.col("records").isNull()
    if others:
        closer = closer | F.rlike("page", F.lit(_look_closer(declared)))

    def one(text: Column) -> Column:
        keys, fields = F.json_object_keys(text), F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
        r = F.from_json(text, plain)
        return F.struct(*[r[c].alias(c) for c in declared],
                        F.map_filter(fields, lambda k, _: ~k.isin(*declared)).alias(_KEYS),
                        (F.coalesce(F.size(keys), F.lit(0)) > 0).alias(_SOUND),
                        fields.isNotNull().alias(_WHOLE))  # a key that stands twice leaves no VARIANT

    split = F.transform(F.from_json("page", "array<string>"), one)
    # whatever is no sound record gives one corrupt row of its text besides those of its records
    none = F.array(F.lit(None).cast(record))
    bad = F.exists("split", lambda e: ~e[_SOUND] | ~e[_WHOLE])
    looked = F.when(F.col("split").isNull(), none).otherwise(F.concat(
        F.filter("split", lambda e: e[_SOUND]), F.when(bad, none).otherwise(F.slice(none, 1, 0))))
    found = (parsed.withColumn("closer", closer)
             .withColumn("split", F.when(F.col("closer"), split))
             .select(*carry, F.when(F.col("closer"), F.col("value")).alias("value"),
                     F.explode(F.when(F.col("closer"), looked).otherwise(F.col("records"))).alias("e")))
    other = F.col("e")[_KEYS]
    return found.select(
        *carry, *[F.col("e")[c].alias(c) for c in declared],
        F.when(F.size(other) > 0, F.to_variant_object(other)).alias("extra"),
        F.when(F.col("e").isNull(), F.col("value")).alias("corrupt_record"))


#: a line that begins with a key stands inside a record that goes over several lines
_INSIDE_RECORD = rf'^[\s,]*"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*:'


def spread_files(lines: DataFrame) -> list[str]:
    """Files whose records go over several lines (pretty-printed pages), from one cheap pass
    over the lines. The driver holds their names, as it holds those of all files it reads."""
    # most lines begin with a brace or bracket: only those that begin with a text meet the pattern
    inside = F.startswith(F.ltrim("value", F.lit(" \t\n\x0b\f\r,")), F.lit('"')) & F.rlike("value", F.lit(_INSIDE_RECORD))
    found = lines.where(inside).select(F.col("_metadata.file_path").alias("uri")).distinct()
    return sorted(r["f"] for r in found.select(file_path("uri").alias("f")).collect())


def file_path(uri: str = "_metadata.file_path") -> Column:
    """Path of the file that a row is read from (the metadata column holds it as a URI)."""
    return F.url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, modified, size) of the files; their contents are not read."""
    return spark.read.format("binaryFile").load(paths).select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def landing_texts(spark: SparkSession, paths: list[str], layout: str = "auto") -> list[tuple[DataFrame, bool]]:
    """The texts of landing files (column ``value``), and whether they are whole pages."""
    if layout not in ("auto", "lines", "pages"):
        raise ValueError(f"unknown layout {layout!r}")
    if not paths:
        return []
    lines = spark.read.text(paths)
    if layout == "pages":
        return [(spark.read.text(paths, wholetext=True), True)]
    spread = spread_files(lines) if layout == "auto" else []
    if not spread:
        return [(lines, False)]
    pages, known = spark.read.text(spread, wholetext=True), set(spread)
    others = [r["path"] for r in list_files(spark, paths).select("path").collect() if r["path"] not in known]
    return ([(spark.read.text(others), False)] if others else []) + [(pages, True)]


def read_landing(spark: SparkSession, path: str | list[str],
                 schema: T.StructType = schemas.BRONZE_RAW, layout: str = "auto") -> DataFrame:
    """Raw record files of any layout. ``layout`` says how texts are cut: ``lines`` (records
    or arrays on single lines; files are split over tasks), ``pages`` (a file is one page,
    read by one task) or ``auto``, which reads as pages those files whose records go over
    several lines."""
    parts = landing_texts(spark, [path] if isinstance(path, str) else list(path), layout)
    if not parts:
        parts = [(spark.createDataFrame([], "value string"), False)]
    return reduce(DataFrame.unionByName, [parse_records(t, schema, pages) for t, pages in parts])


def profile(raw: DataFrame) -> DataFrame:
    """Counts of a landing read: records, corrupt lines, records with undeclared keys."""
    corrupt = F.col("corrupt_record").isNotNull()
    return raw.agg(F.count_if(~corrupt).alias("records"), F.count_if(corrupt).alias("corrupt_lines"),
                   F.count_if(F.col("extra").isNotNull()).alias("records_with_extra"))


def since_year(df: DataFrame, year_from: int | None, column: str = "date_occ") -> DataFrame:
    """Keep records with ``date_occ >= 'YYYY-01-01T00:00:00'`` (text compare)."""
    if year_from is None:
        return df
    return df.where(F.col(column) >= F.lit(f"{int(year_from):04d}-01-01T00:00:00"))


def with_lineage(df: DataFrame, run_ts: Column | str | None = None,
                 source: str = "landing") -> DataFrame:
    ts = (F.current_timestamp() if run_ts is None
          else (F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts))
    return df.withColumns({
        "ingest_date": F.to_date(ts),
        "processing_datetime": ts,
        "data_source": F.lit(source),
    })


def bronze_columns(raw: DataFrame, year_from: int | None = None,
                   run_ts: Column | str | None = None, source: str = "landing") -> DataFrame:
    """Parsed landing rows -> bronze: raw text columns, lineage, ``extra``. The rows of
    corrupt lines are no records (``profile`` counts them)."""
    records = since_year(raw.where(F.col("corrupt_record").isNull()), year_from)
    return with_lineage(records, run_ts, source).select(*schemas.BRONZE.fieldNames())


def ingest(spark: SparkSession, landing: str | list[str], year_from: int | None = None,
           run_ts: Column | str | None = None, source: str = "landing",
           layout: str = "auto", index: str | None = None) -> DataFrame:
    """Landing JSON -> bronze DataFrame (raw text columns + lineage + other keys). With the
    path of a skip ``index`` (see ``update_index``) files that end before ``year_from`` are
    not read."""
    paths = [landing] if isinstance(landing, str) else list(landing)
    if index is not None and year_from is not None:
        paths = files_since(spark, paths, index, year_from)
    return bronze_columns(read_landing(spark, paths, layout=layout), year_from, run_ts, source)


# --- skip index of landing files ------------------------------------------------------
INDEX = T.StructType([T.StructField(n, t) for n, t in (
    ("path", T.StringType()), ("modified", T.TimestampType()), ("size", T.LongType()),
    ("first_date", T.StringType()), ("last_date", T.StringType()), ("records", T.LongType()),
    ("corrupt", T.LongType()))])


def zones(spark: SparkSession, paths: list[str], layout: str = "auto") -> DataFrame:
    """(path, first_date, last_date, records, corrupt): the range of ``date_occ`` in each
    file, as text. Files without a line have no row."""
    date = T.StructType([T.StructField("date_occ", T.StringType())])
    parts = [parse_records(t.select("value", F.col("_metadata.file_path").alias("uri")), date, pages, others=False, carry=["uri"])
             for t, pages in landing_texts(spark, paths, layout)]
    corrupt = F.col("corrupt_record").isNotNull()
    found = reduce(DataFrame.unionByName, parts).groupBy("uri").agg(
        F.min("date_occ").alias("first_date"), F.max("date_occ").alias("last_date"),
        F.count_if(~corrupt).alias("records"), F.count_if(corrupt).alias("corrupt"))
    # one path to decode for each file, not for each record
    return found.select(file_path("uri").alias("path"), "first_date", "last_date", "records", "corrupt")


def read_index(spark: SparkSession, index: str) -> DataFrame:
    found = versions(spark, index)
    return (read_version(spark, f"{index}/{found[-1]}", INDEX) if found
            else spark.createDataFrame([], INDEX))


_SAME_FILE = ["path", "modified", "size"]


def update_index(spark: SparkSession, landing: str | list[str], index: str, layout: str = "auto") -> DataFrame:
    """Brings the skip index (a table with a row per file) up to the files of a landing
    folder: only new and changed files are parsed. Returns the index."""
    there = list_files(spark, [landing] if isinstance(landing, str) else list(landing))
    old = read_index(spark, index)
    new = [r["path"] for r in there.join(old, _SAME_FILE, "left_anti").select("path").collect()]
    rows = old.join(there, _SAME_FILE, "left_semi")
    if new:
        zone = zones(spark, new, layout).join(there, "path", "right").where(F.col("path").isin(new))
        rows = rows.unionByName(zone.select(*[
            F.coalesce(c, F.lit(0)).alias(c) if c in ("records", "corrupt") else F.col(c) for c in INDEX.fieldNames()]))
    root, layer, table = index.rstrip("/").rsplit("/", 2)
    write_layer(rows, root, layer, table)
    return read_index(spark, index)


def files_since(spark: SparkSession, landing: list[str], index: str, year_from: int) -> list[str]:
    """Files that may hold a record since the year: those whose last date reaches it, and all
    that the index does not know as they are now."""
    bound = f"{int(year_from):04d}-01-01T00:00:00"
    known = read_index(spark, index).select(*_SAME_FILE, "last_date", F.lit(True).alias("known"))
    kept = (list_files(spark, landing).join(known, _SAME_FILE, "left")
            .where(F.col("known").isNull() | (F.col("last_date") >= bound)))
    return sorted(r["path"] for r in kept.select("path").collect())


def write_landing(df: DataFrame, path: str) -> None:
    """Write raw records as JSON lines (the shape ``read_landing`` expects)."""
    df.select(*schemas.BRONZE_RAW_COLUMNS).write.mode("overwrite").json(path)


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def versions(spark: SparkSession, table_path: str) -> list[str]:
    """Committed versions of a table, oldest first."""
    return [v for v in files.names(spark, table_path)
            if v.startswith("v") and files.exists(spark, f"{table_path}/{v}/_SUCCESS")]


def current(spark: SparkSession, root: str, layer: str, table: str) -> str:
    """Path of the newest committed version of a layer table."""
    path = layer_path(root, layer, table)
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no committed version of {path}")
    return f"{path}/{found[-1]}"


def evolved(df: DataFrame, before: T.StructType) -> DataFrame:
    """Adds the columns that the table had before and ``df`` lacks, as nulls."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in before
                            if f.name not in df.columns])


def write_layer(df: DataFrame, root: str, layer: str, table: str,
                partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, evolve: bool = False) -> str:
    """Full overwrite of ``<root>/<layer>/<table>`` as a new version; the schema is
    replaced, or with ``evolve`` keeps every column that the table ever had.

    ``sort_within`` orders rows inside each task (no shuffle) so Parquet row-group
    statistics on that column become selective for later filters. Returns the new
    version's path; versions before the last ``KEPT_VERSIONS`` are removed.
    """
    spark, path = df.sparkSession, layer_path(root, layer, table)
    found = versions(spark, path)
    if evolve and found:
        df = evolved(df, spark.read.parquet(f"{path}/{found[-1]}").schema)
    if sort_within:
        df = df.sortWithinPartitions(*((partition_by or []) + sort_within))
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    new = f"{path}/v{time.time_ns():020d}"
    w.parquet(new)
    for old in found[:len(found) + 1 - KEPT_VERSIONS]:
        files.remove(spark, f"{path}/{old}")
    return new


def read_layer(spark: SparkSession, root: str, layer: str, table: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Read the newest committed version of a layer table."""
    return read_version(spark, current(spark, root, layer, table), schema)


def read_version(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
