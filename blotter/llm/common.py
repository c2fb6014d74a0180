"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: a word is a maximal run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words (see ``WORD``); null text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder shared by the cluster."""
    return f"{shared_dir(spark)}/blotter-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared checkpoint folder."""
    sc, folder = df.sparkSession.sparkContext, shared_dir(df.sparkSession)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def unit_hash(key: Column) -> Column:
    """Order key shared by Spark and SQL: the first 32 bits of md5, 0 .. 2^32-1."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")


def blocks_for(rows: int, rows_per_block: int) -> int:
    return max(1, -(-rows // rows_per_block))


def block_of(h: Column, blocks: int) -> Column:
    """Block 0 .. blocks-1 of a 32-bit order key; ascending with the key."""
    return F.shiftright(h * F.lit(blocks).cast("long"), 32)
