"""Hyperdimensional language ID: brute-force bundles, held-out accuracy, edge rows."""

import os
import subprocess
import sys
import zlib

import numpy as np
import pytest

from blotter.llm import langid


def plain_bundle(text):
    """Trigram by trigram, from the definition."""
    v = np.zeros(langid.DIMENSIONS)
    words, word = [], ""
    for ch in text.lower():
        if ch.isalpha():
            word += ch
        elif word:
            words.append(word)
            word = ""
    for w in words + ([word] if word else []):
        codes = [0, *map(ord, w), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            va, vb, vc = map(langid.letter_vector, (a, b, c))
            v += np.roll(va, 2) * np.roll(vb, 1) * vc
    return v


TEXTS = ["The cat, the hat.", "", "a", "  x1y22zz\n\nÉté ", "漢字 かな und ß", "123 !?", "Ⅷ ÀÀ aé", "don't"]


def test_bundles_equal_the_definition(monkeypatch):
    want = np.stack([plain_bundle(t) for t in TEXTS])
    assert (langid.bundles(TEXTS, list(range(len(TEXTS))), len(TEXTS)) == want).all()
    assert (langid.bundles(TEXTS, [0] * len(TEXTS), 1)[0] == want.sum(axis=0)).all()
    monkeypatch.setattr(langid, "TRIPLES", 10)  # the sorted way for large alphabets
    assert (langid.bundles(TEXTS, list(range(len(TEXTS))), len(TEXTS)) == want).all()


def test_long_texts_are_bundled_whole(monkeypatch):
    text = "one two, threefour " * 50 + "x" * 300
    want = plain_bundle(text)
    monkeypatch.setattr(langid, "CHARS", 37)
    assert (langid.bundles([text, None], [1, 0], 2) == np.stack([0 * want, want])).all()


DENSE = """
import random, resource
from blotter.llm import langid
rnd = random.Random(1)
han = [chr(c) for c in range(0x4E00, 0x9FA5)]
texts = ["".join(rnd.choices(han, k=%d)) for _ in range(%d)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
langid.bundles(texts, list(range(len(texts))), len(texts))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("size, count", [(500_000, 1), (1900, 256)])
def test_dense_scripts_take_bounded_memory(size, count):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", DENSE % (size, count)], cwd=root, capture_output=True, text=True, check=True)
    assert int(run.stdout) < 500


def test_slices_equal_the_definition(monkeypatch):
    want = np.stack([plain_bundle(t) for t in TEXTS])
    monkeypatch.setattr(langid, "BOUND", 3)
    monkeypatch.setattr(langid, "LETTERS", 2)
    monkeypatch.setattr(langid, "_LETTERS", {})
    assert (langid.bundles(TEXTS, list(range(len(TEXTS))), len(TEXTS)) == want).all()


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    with pytest.raises(ValueError):
        langid.predictions(frame(spark, [(i, "a text", f"l{i}", "") for i in range(40)]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_edge_rows(spark):
    rows = [(1, "the end of the", "en", "s"), (2, "le fin de la", "fr", "s"), (3, "the", None, "s"),
            (4, None, "en", "s"), (5, " 12 --", "fr", "s"), (None, "la fin", "fr", "s"), (1, "the end of the", "en", "s")]
    rows += [(i, "the end of this", "en", "") for i in range(100, 110)] + [(i, "la fin de ce", "fr", "") for i in range(200, 210)]
    got = langid.predictions(frame(spark, rows))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[1]) == 2 and by[1][0] == by[1][1]
    assert (by[3][0].lang_pred, by[4][0].lang_pred, by[5][0].lang_pred) == ("en", "und", "und")
    assert by[4][0].score == 0 and 0 < by[3][0].score <= 1 and by[None][0].lang_pred == "fr"
    assert all(r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2)
               for d, rs in by.items() for r in rs)
    kept = langid.keep_identified(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.count() == len(rows) - 2


def test_nothing_to_learn_from(spark):
    assert langid.predictions(frame(spark, [])).count() == 0
    got = langid.predictions(frame(spark, [(1, "a b", None, "")])).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_texts_with_letters_are_kept_whatever_was_learned(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    texts = ["a b", None, "12 --", "", "Été"]
    for langs in ([None] * 5, ["en"] * 5, ["und"] * 5):  # no label, held-out labels, a label of that name
        first = 0 if langs[0] == "und" else held
        rows = [(first, t, x, str(n)) for n, (t, x) in enumerate(zip(texts, langs))]
        kept = langid.keep_identified(frame(spark, rows))
        assert sorted(map(tuple, kept.collect())) == [rows[0], rows[4]]


def test_held_out_accuracy_and_partitions(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = [r for r in got.collect() if r.held_out]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    again = langid.predictions(docs.repartition(7))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, langid.predictions(docs).collect()))
