"""Prefix counts against encoding every prefix anew."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blotter.llm import byte_bpe, prefix_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def n(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def check(text):
    (table,) = prefix_counts.tables([text], PATH)
    counts = table.counts()
    assert len(counts) == len(text.encode()) + 1
    at = [len(text[:i].encode()) for i in range(len(text) + 1)]
    want = [n(text[:i]) for i in range(len(text) + 1)]
    assert [counts[b] for b in at] == want, text
    assert table.n_tokens == n(text)
    for budget in (0, 1, 3, 10):
        assert table.fits(budget) == max(b for b, c in zip(at, want) if c <= budget)


ODD = ["", " ", "  ", "   a", "a  b", "a \n b", "a\n\n\nb  ", "a\t", "we're they've I'll don't 's", "'re", "x'r", "''re", " 're",
       "<|endoftext|>", "a!<|endoftext|>!b", " <|endoftext|> <|endoftext|><|endoftext|>", "ab  <|endoftext|>", "\n<|endoftext|>\n",
       "été 漢字🙂 का", "x　 y", "!!! ... ???", "12 345", "internationalization counterintuitively", "\r\n\r\n a", "a \xa0 b",
       "a \0 ", "\0 ", "\0", "The \x85\x1c ", "The \xa0\x1c ", "a \x1d\x1e b \x1f", " \x1c\n"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aetrsl '\n\t 1,.!é字　\xa0") | st.characters(exclude_categories=["Cs"]), max_size=24))
def test_any_text(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("a \n\0\x1c\x1d\x1e\x1f\x85\xa0\u2028!'"), max_size=14))
def test_control_characters(text):
    check(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "'ll", "a", "!", "\n", "the", "<|", "é"]), max_size=9))
def test_special_strings(pieces):
    check("".join(pieces))


def test_prose_and_long_words():
    rnd = random.Random(1)
    prose = " ".join("".join(rnd.choice(["th", "er", "tion", "ing", "a", "é"]) for _ in range(rnd.randrange(1, 6)))
                     + rnd.choice(["", "", ",", ".\n"]) for _ in range(120))
    check(prose)
    check("".join(rnd.choice("abcdefgh") for _ in range(700)))


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMORY", 3)
    monkeypatch.setattr(prefix_counts, "WORDS", 2)
    monkeypatch.setattr(prefix_counts, "PAIRS", 2)
    monkeypatch.setattr(prefix_counts, "_COUNTERS", {})
    for text in ("one two three four one two", "the internationalization of a thing"):
        check(text)


def test_frames(spark):
    rows = [(1, "word " * 600, "x"), (2, None, "x"), (None, "é a", "x"), (3, "", "x"), (1, "word " * 600, "x"), (4, "a " * 30000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, prefix_counts.budgets(df, PATH).collect()), key=str)
    want = []
    for d, t, _ in rows:
        t = t or ""
        (table,) = prefix_counts.tables([t], PATH)
        want.append((d, len(t.encode()), n(t), n(t) > 512, table.fits(512)))
    assert got == sorted(want, key=str)
    counts = prefix_counts.prefix_counts(df.where("doc_id is null"), PATH).first().counts
    assert [counts[b] for b in (0, 2, 3, 4)] == [0, n("é"), n("é "), n("é a")]
    assert prefix_counts.budgets(df.limit(0), PATH).count() == 0
