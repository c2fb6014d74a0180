"""The pipeline's stages against plain statements of their rules, each on its own input."""

import random

import pytest

import corpus_pipeline
from blotter.llm import langid
from conftest import scratch
from test_simhash import plain_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(7)
    words = {"en": "the of and to in that with for", "fr": "le la de et que dans pour sur"}
    rows = []
    for i in range(240):
        lang = rnd.choice(["en", "fr"])
        text = " ".join(rnd.choice(words[lang].split()) + rnd.choice(["", "er", "ing", "eau"]) for _ in range(rnd.choice([3, 40, 200])))
        rows.append((i, text, rnd.choice([lang, None]), rnd.choice(["a", "a", "a", "b", "c", None]), len(text)))
    rows += [(1000 + i, rows[3][1], "en", "b", 1) for i in range(60)]
    rows += [(2000, None, "en", "a", None), (2001, "12 34 --", "en", "a", 8), (2002, "", None, "a", 0), (None, "the end of it all", "en", "a", 1)]
    rows += [rows[9], rows[9]]
    return rows


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    path, seen = scratch(spark, "pipe-"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], "").write.parquet(f"{path}/{name}")
        seen.append(spark.read.parquet(f"{path}/{name}"))
    return seen


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(stages):
    for df in stages[1:4]:
        assert df.columns == stages[0].columns and [t for _, t in df.dtypes] == [t for _, t in stages[0].dtypes]


def test_language_id_keeps_texts_with_letters(stages):
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[1] and any(map(str.isalpha, r[1]))]
    assert langid.UNKNOWN == "und"


def test_near_dedup_keeps_the_smallest_of_each_group(stages):
    given, kept = rows(stages[1]), rows(stages[2])
    groups = plain_groups([(r[0], r[1]) for r in given])
    assert set(kept) <= set(given) and len(kept) == len(set(kept))
    assert sorted([r[0] for r in kept if r[0] is not None]) == sorted({c for _, _, c in groups if c is not None})


def test_mixing_meets_the_targets(stages):
    given, mixed = rows(stages[2]), rows(stages[3])
    size, took, longest = {}, {}, {}
    for r in given:
        n = len(r[1].split())
        size[r[3]] = size.get(r[3], 0) + n
        longest[r[3]] = max(longest.get(r[3], 0), n)
    for r in mixed:
        took[r[3]] = took.get(r[3], 0) + len(r[1].split())
    assert set(mixed) <= set(given) and max(mixed.count(r) for r in mixed) <= 2
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, budget, open_ = {}, 1.5 * sum(size.values()), set(order)
    while open_:  # reshare until none is above
        rate = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if rate * weight[s] > 2 * size[s]}
        if not above:
            target.update({s: rate * weight[s] for s in open_})
            break
        target.update({s: 2 * size[s] for s in above})
        open_ -= above
    for s in order:
        assert abs(took.get(s, 0) - target[s]) <= longest[s] / 2 + 1


def test_packing_places_every_chunk_once(stages):
    given, packed = rows(stages[3]), stages[4].collect()
    assert sum(r.words for r in packed) == sum(len(r[1].split()) for r in given)
    bins = {}
    for r in packed:
        bins.setdefault(r.bin_id, []).append(r)
    assert all(sum(r.words for r in b) <= 2048 for b in bins.values())
    source = {r[0]: r[3] for r in given}
    assert all(len({source[r.doc_id] for r in b}) == len(b) for b in bins.values())


def test_run_over_the_table(spark, sf_small):
    got = corpus_pipeline.run(spark, sf_small)
    assert got.columns == ["doc_id", "chunk", "first_word", "words", "bin_id", "start"] and got.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_no_language_is_labelled(spark):
    docs = spark.createDataFrame([(i, f"word{i} and{i} more{i}", None, "a", 10) for i in range(12)], SCHEMA)
    first = corpus_pipeline.STAGES[0][1](spark, docs, "")
    assert rows(first) == rows(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() > 0
