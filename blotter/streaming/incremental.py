"""Incremental silver: new landing JSON files -> cleaned silver rows.

The cleaning steps are stateless column expressions, so the batch operators
apply unchanged to a streaming DataFrame. A file-source stream with an
``availableNow`` trigger processes only files not seen before (tracked in the
checkpoint) and appends their silver rows, then stops — an incremental refresh
without re-reading the whole landing zone. ``start_fact_refresh`` goes on to the gold
fact and the marts: each micro-batch is merged by ``plans.upsert`` as one commit.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean
from ..plans import upsert
from ..session import shared_dir
from ..sources import landing


def silver_stream(spark: SparkSession, landing_dir: str, year_from: int | None = None,
                  run_ts: Column | str | None = None,
                  max_files_per_trigger: int | None = None, pages: bool = False) -> DataFrame:
    """``pages`` reads each file as one page, for records that go over several lines."""
    reader = spark.readStream.option("wholetext", str(pages).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    raw = landing.parse_records(reader.text(landing_dir), pages=pages)
    return clean.silver(landing.bronze_columns(raw, year_from, run_ts))


def start_silver_refresh(spark: SparkSession, landing_dir: str, out_dir: str,
                         checkpoint_dir: str | None = None, **kw) -> StreamingQuery:
    """Append silver rows for landing files not yet processed; stops when caught up.

    The checkpoint defaults to a folder under the shared ``spark.checkpoint.dir`` that
    belongs to this pair of landing and output folder, so every output gets all files.
    """
    pair = hashlib.sha256(f"{landing_dir.rstrip('/')}\n{out_dir.rstrip('/')}".encode()).hexdigest()[:32]
    ckpt = checkpoint_dir or f"{shared_dir(spark)}/blotter-streams/silver-{pair}"
    return (silver_stream(spark, landing_dir, **kw)
            .writeStream.format("parquet")
            .option("path", out_dir)
            .option("checkpointLocation", ckpt)
            .outputMode("append")
            .trigger(availableNow=True)
            .start())


def start_fact_refresh(spark: SparkSession, landing_dir: str, root: str, checkpoint_dir: str | None = None,
                       year_from: int | None = None, run_ts: Column | str | None = None, pages: bool = False,
                       max_files_per_trigger: int | None = None, buckets: int = upsert.BUCKETS) -> StreamingQuery:
    """Merges landing files not yet processed into the fact and marts under ``root``, and stops when
    caught up. A micro-batch that is run again after a failure changes nothing."""
    pair = hashlib.sha256(f"{landing_dir.rstrip('/')}\n{root.rstrip('/')}".encode()).hexdigest()[:32]
    reader = spark.readStream.option("wholetext", str(pages).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    bronze = landing.bronze_columns(landing.parse_records(reader.text(landing_dir), pages=pages), year_from, run_ts)
    return (bronze.writeStream.foreachBatch(lambda df, _: upsert.apply_batch(df.sparkSession, df, root, buckets) and None)
            .option("checkpointLocation", checkpoint_dir or f"{shared_dir(spark)}/blotter-streams/fact-{pair}")
            .trigger(availableNow=True).start())
