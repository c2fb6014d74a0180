"""Curriculum mixing: targets, exact takes, positions, blocks and edge rows."""

import random
from fractions import Fraction

import pytest

from blotter.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, h string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", "y", "z") for d, t, s in rows], SCHEMA)


def corpus(n=300, seed=1):
    rnd = random.Random(seed)
    rows = [(i, "w " * rnd.choice([1, 7, 30, 300]), rnd.choice(["hot", "hot", "b", "c", "é", "Z", None])) for i in range(n)]
    return rows + [(n, None, "b"), (n + 1, "", "empty"), (None, "a b", "b"), (3, "again x", "c"), (3, "again x", "c")]


def words(t):
    return len((t or "").split())


def plain_targets(size, share=Fraction(3, 2), cap=2):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        rate = (share * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if rate * weight[s] > cap * size[s]}
        if not above:
            target.update({s: rate * weight[s] for s in open_})
            break
        target.update({s: Fraction(cap * size[s]) for s in above})
        open_ -= above
    return target


@pytest.mark.parametrize("per_block", [10_000, 7])
def test_targets_and_takes(spark, per_block):
    rows = corpus()
    got = mixing.document_mix(mixing.plan_mix(frame(spark, rows), rows_per_block=per_block)).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + words(t)
    target = plain_targets(size)
    took, source = {}, {}
    for d, t, s in rows:
        source.setdefault(d, s)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and abs(r.target - float(target[s])) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        took[s] = took.get(s, 0) + r.taken
    assert all(took[s] == int(float(target[s]) + 1e-9) for s in size)
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    again = mixing.document_mix(mixing.plan_mix(frame(spark, rows[::-1]).repartition(5), rows_per_block=per_block)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_positions_follow_the_schedule(spark):
    """A source whose weight falls from 2 to 0 gives half its words in the first 29 %."""
    rows = [(i, "w", "s") for i in range(1000)]

    def falling(sources):
        f = mixing.F
        piece = f.struct(f.lit(0.0).alias("t0"), f.lit(1.0).alias("t1"), f.lit(2.0).alias("w0"), f.lit(0.0).alias("w1"))
        return sources.select("skey", f.array(piece).alias("pieces"))

    got = mixing.document_mix(mixing.plan_mix(frame(spark, rows), falling, budget_share=1.0)).collect()
    half = sum(r.position < 1 - 0.5 ** 0.5 for r in got)
    assert abs(half - 500) <= 1

    def steps(sources):  # nothing, then 3 parts, then 1 part
        f = mixing.F
        piece = lambda a, b, w: f.struct(f.lit(a).alias("t0"), f.lit(b).alias("t1"), f.lit(w).alias("w0"), f.lit(w).alias("w1"))
        return sources.select("skey", f.array(piece(0.0, 0.2, 0.0), piece(0.2, 0.6, 3.0), piece(0.6, 1.0, 1.0)).alias("pieces"))

    got = mixing.document_mix(mixing.plan_mix(frame(spark, rows), steps, budget_share=1.0)).collect()
    assert min(r.position for r in got) >= 0.2 and sum(r.position < 0.6 for r in got) == 750


def test_whole_copies_in_training_order(spark):
    rows = corpus()
    planned = mixing.plan_mix(frame(spark, rows), whole=True)
    mixed = mixing.training_order(planned)
    assert mixed.columns == ["doc_id", "text", "source", "size", "h", "block"]
    copies = {}
    for r in mixed.collect():
        copies[(r.doc_id, r.source)] = copies.get((r.doc_id, r.source), 0) + 1
    assert max(v for (d, _), v in copies.items() if d != 3) <= 2
    for r in planned.collect():
        assert all(c.take == r["size"] for c in r.copies)


def test_empty(spark):
    assert mixing.document_mix(mixing.plan_mix(frame(spark, []))).count() == 0
    only = mixing.document_mix(mixing.plan_mix(frame(spark, [(1, None, None), (2, "", "a")]))).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in only] == [(0, 0, 0.0, 0)] * 2
