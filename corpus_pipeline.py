"""Training-corpus pipeline over the table ``documents``.

``STAGES`` are (name, function) pairs; every function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's ``docs``:

1. ``language_id``: documents without any letter have no language and go;
2. ``near_dedup``: of each group of SimHash near-duplicates the smallest doc_id stays;
3. ``mixing``: sources are mixed to target weights along a curriculum; a document stands
   once for each time the mix takes it, in training order;
4. ``packing``: one row per chunk of a document with its bin and place.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import langid, mixing, packing, simhash
from blotter.llm.common import scratch_path
from blotter.session import ensure_shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_shared_dir(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(mixing.plan_mix(docs, whole=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.numbered_bins(packing.pack(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack)]

#: language prototypes, fingerprints and best-fit search have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's result is kept in the shared folder."""
    ensure_shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{number}-{name}")
        docs = spark.read.parquet(f"{path}/{number}-{name}")
    return docs
