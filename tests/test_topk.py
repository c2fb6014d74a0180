"""Two-phase top-k against counting everything."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.operators import topk


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 50), st.integers(1, 30), max_size=40), st.integers(1, 20))
def test_summaries_bound_every_count(counts, size):
    got, off = topk.reduced(dict(counts), size)
    assert len(got) <= size and all(counts[v] - off <= got.get(v, 0) <= counts[v] for v in counts if v in got)
    assert all(n <= off for v, n in counts.items() if v not in got)


def frame(spark, values):
    return spark.createDataFrame([(v, 1) for v in values], "v string, n int").repartition(6)


def plain(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]


def skewed(rnd):
    return [f"hot{i}" for i in range(12) for _ in range(400 - 20 * i)] + [f"cold{rnd.randrange(10**6)}" for _ in range(6000)] + [None] * 900


@pytest.mark.parametrize("size", [30, 200, 10_000])
def test_skewed_values(spark, size):
    values = skewed(random.Random(3))
    df = frame(spark, values)
    for k in (1, 5, 12):
        assert [tuple(r) for r in topk.top_counts(df, "v", k, size=size).collect()] == plain(values, k)
    few = topk.candidates(df, "v", 5, size)
    assert few is not None and few.count() <= 20


def test_flat_and_tied_values(spark):
    values = [f"v{i:04d}" for i in range(3000)] * 2
    df = frame(spark, values)
    assert topk.candidates(df, "v", 7, 50) is None  # the errors cannot tell: all are counted
    assert [tuple(r) for r in topk.top_counts(df, "v", 7, size=50).collect()] == plain(values, 7)
    tied = ["a", "b", "c"] * 50 + ["d"] * 50 + ["e"] * 49
    assert [tuple(r) for r in topk.top_counts(frame(spark, tied), "v", 3, size=4).collect()] == plain(tied, 3)


def test_small_and_empty(spark):
    assert [tuple(r) for r in topk.top_counts(frame(spark, ["a", None, "a", "b"]), "v", 9).collect()] == [("a", 2), ("b", 1)]
    none = frame(spark, ["a"]).limit(0)
    assert topk.top_counts(none, "v", 3).count() == 0 and topk.top_counts(frame(spark, ["a"]), "v", 0).count() == 0
    numbers = spark.range(100).select((F.col("id") % 7).alias("v"))
    assert [tuple(r) for r in topk.top_counts(numbers, "v", 2).collect()] == [(0, 15), (1, 15)]
