"""Mixture packing: exact ids, whole windows, proportions of every window."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blotter.llm import mixture_packing, queries, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
COLUMNS = "doc_id long, text string, source string, ids string, block int"


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    out = []
    for flat, ends in word_bpe.encoder(PATH)(pa.array(texts, pa.string())):
        out += [x.tolist() for x in np.split(flat, ends[:-1])]
    return out


ODD = ["", " ", "a", None, "Été  où\n\nx", "don't 'tis we're 's 've IT'S", "a<|endoftext|>b <|startoftext|>. x", "é ́a .́", "ΑΣ Σ ΣΑ.",
       "İ.İ, İ", "क़.क", "a b\tc\x1cd.\x1c", "12 345a 3.14,5", "!!! ...,a ,. x,", "漢字。 🙂. का", "x" * 300 + " y", "\0 a. \0", "a'", "x.'s", "_.a,_",
       "µ ª º.", "÷ × a÷.", "Ǆ ﬁ Å K.", "a\x85b  c", ".", ",."]


def test_odd_texts():
    assert encoded(ODD) == [ids(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sTÉé \n\t<|.,!1ΣİK漢क़́\0\x1c\xa0_") | st.characters(exclude_categories=["Cs"]), max_size=16), max_size=5))
def test_any_text(texts):
    assert encoded(texts) == [ids(t) for t in texts]


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr(word_bpe, "_ENCODERS", {})
    monkeypatch.setattr(word_bpe, "BYTES", 60)
    monkeypatch.setattr(word_bpe, "MEMORY", 5)
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 90) for _ in range(9)) for _ in range(40)] + ODD
    assert encoded(texts) == [ids(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 90), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 40), st.randoms())
def test_round_robin(queues, grain, rnd):
    total, capacity = sum(map(sum, queues)), 64
    shares = [sum(q) / total for q in queues]
    carry = [rnd.uniform(-grain, grain) for _ in queues]
    got = list(mixture_packing.fill(queues, shares, list(carry), capacity, grain))
    sizes = mixture_packing.capacities(total, capacity)
    assert sum(sizes) == total and all(s == capacity or s & (s - 1) == 0 for s in sizes)
    at, window, sent = [0] * len(queues), defaultdict(int), [0] * len(queues)
    begun = [[0] * len(q) for q in queues]
    for q, doc, start, n, w, offset in got:
        assert n > 0 and offset == window[w] and start == begun[q][doc] and doc >= at[q]  # queues in order, no gap
        window[w] += n
        begun[q][doc] += n
        sent[q] += n
        at[q] = doc
    assert [window[w] for w in range(len(sizes))] == sizes
    assert begun == queues


def test_proportions_hold_in_every_window():
    rnd = random.Random(5)
    queues = [[rnd.randrange(1, 3000) for _ in range(n)] for n in (2000, 400, 100, 30, 3)]
    total = sum(map(sum, queues))
    shares = [sum(q) / total for q in queues]
    sent, last = [0] * 5, -1
    for q, _, _, n, w, offset in mixture_packing.fill(queues, shares, [0.0] * 5):
        if offset == 0 and w:
            for s, p in zip(sent, shares):  # what is owed at the end of a window stays within two grains
                assert abs(p * w * 4096 - s) <= 2 * mixture_packing.GRAIN + 5 or w * 4096 > total - 4096
        sent[q] += n


def corpus(rnd, n=400):
    texts = ["w%d. " % i * rnd.choice([1, 5, 30, 200]) for i in range(n)]
    rows = [(i, t, rnd.choice(["hot", "hot", "hot", "b", "c", None])) for i, t in enumerate(texts)]
    rows += [(None, None, None), (None, "", "b"), (3, "again and again", "c"), (3, "again and again", "c"), (-1, "long words, " * 9000, "b"), (-2, "x", "rare")]
    return [(*r, "ids", 7) for r in rows]


@pytest.mark.parametrize("partition, chunk, grain, capacity", [(1 << 22, 1 << 16, 256, 4096), (3000, 500, 16, 128), (700, 33, 1, 64)])
def test_every_id_in_one_piece(spark, partition, chunk, grain, capacity):
    rows = corpus(random.Random(2))
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = mixture_packing.pack(docs, PATH, None, capacity, grain, partition, chunk).collect()
    windows = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 4 > 0
        windows[r.sequence_id].append(r)
    assert sorted(windows) == list(range(len(windows)))
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(np.array([*ids(r[1]), 2], "<u4").tobytes())
    joined = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.start, r.doc_tokens)):
        joined[r.doc_id].append(r)
    for doc_id, parts in joined.items():
        if len(want[doc_id]) == 1:
            (whole,) = want[doc_id]
            assert b"".join(r.ids for r in parts) == whole and [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts[:-1]]).tolist()
            assert {r.doc_tokens for r in parts} == {len(whole) // 4}
        else:
            assert sum(len(r.ids) for r in parts) == sum(map(len, want[doc_id]))
    assert set(joined) == set(want)


def test_partitions_carry_the_proportions(spark):
    rnd = random.Random(8)
    rows = [(i, "a b c d " * rnd.randrange(1, 60), rnd.choice(["x", "x", "y", "z"]), "", 0) for i in range(900)]
    source = {r[0]: r[2] for r in rows}
    tokens = {r[0]: len(r[1].split()) + 1 for r in rows}
    total = sum(tokens.values())
    docs = spark.createDataFrame(rows, COLUMNS)
    got = mixture_packing.pack(docs, PATH, None, 256, 16, 6000).collect()
    share = {s: sum(n for i, n in tokens.items() if source[i] == s) / total for s in "xyz"}
    filled, of = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in got:
        filled[r.sequence_id] += r.length
        of[r.sequence_id][source[r.doc_id]] += r.length
    done, sent = 0, dict.fromkeys("xyz", 0)
    for w in sorted(filled):  # over the borders of partitions too
        done += filled[w]
        for s in "xyz":
            sent[s] += of[w][s]
            assert abs(share[s] * done - sent[s]) < 60, (w, s)
    other = mixture_packing.pack(docs, PATH, {"y": 3, "x": 1}, 256, 16, 1 << 20).collect()
    first = [r for r in other if r.sequence_id < 4]
    assert sum(r.length for r in first if source[r.doc_id] == "y") == pytest.approx(0.75 * 1024, abs=40)
    assert sum(r.length for r in other) == total


def test_empty(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert mixture_packing.pack(none, PATH).collect() == []


def test_query(spark, sf_small):
    got = queries.QUERIES["op13_mixture_packing"](spark, sf_small).toPandas()
    assert sorted(got) == sorted(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    whole = {d: np.array([*ids(t), 2], "<u4") for d, t in texts.items()}
    assert got.groupby("doc_id")["length"].sum().to_dict() == {d: len(w) for d, w in whole.items()}
    for r in got.itertuples():
        assert r.ids_crc32 == zlib.crc32(whole[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(whole[r.doc_id])
