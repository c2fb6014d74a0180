"""SimHash near-dedup against a plain all-pairs statement of the rule."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import simhash
from blotter.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, component string"


def plain_fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(rows, radius=3):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d, f"{f:016x}", ids.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))),
                  key=str)


def groups(spark, rows):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    g = simhash.near_duplicates(df).select(
        "doc_id", simhash.hex_fingerprint(simhash.F.col("fp")).alias("f"), "component_id")
    return sorted((tuple(r) for r in g.collect()), key=str)


def corpus(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for d in range(60):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([2, 5, 60, 300]))]
        rows.append((d * 10, " ".join(base)))
        for k in range(rnd.choice([0, 0, 1, 4])):
            edit = list(base)
            edit[rnd.randrange(len(edit))] = rnd.choice(vocab)
            rows.append((d * 10 + 1 + k, "\t ".join(edit)))
    rows += [(9000, None), (9001, ""), (9002, " \n\x0b "), (None, "w1 w2"), (None, None), (9003, "W1  w2"),
             (9004, "Été ÉTÉ été straße"), (9005, "w1 " * 70000), (5, "same"), (5, "same"), (5, "other")]
    return rows


def test_groups_equal_all_pairs(spark):
    rows = corpus()
    assert groups(spark, rows) == plain_groups(rows)


def test_hot_group_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 7)
    monkeypatch.setattr(simhash, "LANES", 16)
    monkeypatch.setattr(simhash, "MERGE", 20)
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(3000)]
    rows = [(0, " ".join(base))]
    for d in range(1, 120):
        e = list(base)
        for _ in range(rnd.choice([1, 3, 9])):
            e[rnd.randrange(len(e))] = f"x{rnd.randrange(9)}"
        rows.append((d, " ".join(e)))
    assert groups(spark, rows) == plain_groups(rows)


def test_empty_table(spark):
    assert groups(spark, []) == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=40), st.integers(0, 9), st.data())
def test_planes_count_exactly(fps, radius, data):
    near = [f ^ (1 << data.draw(st.integers(0, 63))) for f in fps]
    x = np.array(fps + near, np.uint64)
    planes = simhash.BitPlanes(x)
    for s in range(1, len(x)):
        got = planes.within(s, np.ones(len(x) - s, bool), radius)
        want = [i for i in range(len(x) - s) if bin(int(x[i]) ^ int(x[i + s])).count("1") <= radius]
        assert got.tolist() == want


def test_every_pair_within_the_radius_shares_a_key():
    masks = [m & (2**64 - 1) for m in simhash.key_masks(3)]
    rnd = random.Random(5)
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)
    with pytest.raises(ValueError):
        simhash.key_masks(5, 5)


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_keep_one_keeps_the_columns_and_one_row_a_group(spark):
    rows = [(3, "a b c d", "s"), (3, "a b c d", "s"), (2, "A B  C D", "t"), (9, "q r s t u", None),
            (None, "only null id", "u"), (None, None, "v"), (8, "", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(2, "A B  C D", "t"), (9, "q r s t u", None), (None, "only null id", "u"), (8, "", "w")], key=str)
