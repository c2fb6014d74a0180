"""Exact top-k of a column with very many values, in two phases.

A plain count sends every distinct value of every task through the shuffle. Here each task first
reduces its rows to a summary of at most ``SUMMARY`` values whose counts are too low by a known
error at most (values are dropped by taking the count of the next one off all). The sums of
the summaries bound every value's count from below, and with the sum of the errors from above. Only
values that can reach the k-th largest lower bound are then counted, exactly. If the errors
are too large to tell (flat data), all values are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir

#: values in the summary of a task
SUMMARY = 10_000


def reduced(counts: dict, size: int) -> tuple[dict, int]:
    """The ``size`` most frequent values less the count of the next one, and that count."""
    if len(counts) <= size:
        return counts, 0
    n = np.fromiter(counts.values(), np.int64, len(counts))
    off = int(np.partition(n, len(n) - size - 1)[len(n) - size - 1])
    return {v: c - off for v, c in counts.items() if c > off}, off


def summaries(df: DataFrame, column: str, size: int = SUMMARY) -> DataFrame:
    """(column, n, error): the values of each task's summary, and a row with its error."""
    d = df.select(column).where(F.col(column).isNotNull())
    schema = T.StructType([T.StructField(column, d.schema[column].dataType), T.StructField("n", T.LongType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, error, kind = {}, 0, None
        for b in batches:
            kind = b.column(0).type
            for pair in b.column(0).value_counts().to_pylist():
                counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
            if len(counts) > 2 * size:
                counts, off = reduced(counts, size)
                error += off
        if kind is None:
            return
        counts, off = reduced(counts, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counts, None], kind), pa.array([*counts.values(), None], pa.int64()),
             pa.array([None] * len(counts) + [error + off], pa.int64())], names=schema.names)

    return d.mapInArrow(run, schema)


def candidates(df: DataFrame, column: str, k: int, size: int = SUMMARY) -> DataFrame | None:
    """The values that may be among the k most frequent; None if the summaries cannot tell."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/blotter-topk/{uuid.uuid4().hex}"
    summaries(df, column, size).write.parquet(path)
    found = spark.read.parquet(path)
    lower = found.where("n is not null").groupBy(column).agg(F.sum("n").alias("n"))
    error = found.agg(F.sum("error")).first()[0] or 0
    best = [r["n"] for r in lower.orderBy(F.col("n").desc()).limit(k).select("n").collect()]  # k numbers
    if error and (len(best) < k or best[-1] <= error):
        return None  # a value that no summary holds could be among them
    least = best[-1] - error if len(best) == k else 0
    return lower.where(F.col("n") >= least).select(column)


def top_counts(df: DataFrame, column: str, k: int, name: str = "incidents", size: int = SUMMARY) -> DataFrame:
    """(column, name): the k most frequent values that are not null and their exact counts,
    most frequent first, ties by value."""
    if k <= 0:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).limit(0)
    some = candidates(df, column, k, size)
    counted = df.where(F.col(column).isNotNull()) if some is None else df.join(some, column, "left_semi")
    return (counted.groupBy(column).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(column)).limit(int(k)))
