"""Token files: exact ids of whole texts, layout of the files, places across files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blotter.llm import token_files, word_bpe
from conftest import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    return [np.frombuffer(b"".join(p), "<u4").tolist() for p in token_files.encoder(PATH).of_texts(texts)]


ODD = ["", " ", "  ", "x,\ny. z", "a1, b2.. (c) d;e x×. É. 漢, a|b c|, x<|endoftext|>, y", "\na", "a\n", "a", " a", "a ", "a  b", "a   b", "\n", "a\nb", "a \nb", "a\n b", "\ta b\t", "x\x0b y", "x \x1cy",
       "a　 b", "a  b", "don't 'tis we're 's 've", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b",
       " <|endoftext|>  x", "été 漢字 का 🙂 x", "՘ ࢏ a", "!!! ... ,a", "1 22 a1", "x" * 200 + " y", "\x00 a",
       "a \0 ", "\0 ", "\0", "The \x85\x1c ", "a \x1d\x1e b \x1f"]


def test_odd_texts():
    assert encoded(ODD) == [ids(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab '\n\t s1,.!é字　\0\x1c\x1d\x1e\x1f\x85\xa0<|") | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text(texts):
    assert encoded(texts) == [ids(t) for t in texts]


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr(token_files, "_ENCODERS", {})
    monkeypatch.setattr(word_bpe, "MEMORY", 5)
    monkeypatch.setattr(word_bpe, "BYTES", 40)
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 90) for _ in range(9)) for _ in range(40)]
    assert encoded(texts) == [ids(t) for t in texts]


def test_work_of_a_batch_grows_with_the_batch(monkeypatch):
    """A table of parts is made of each batch, not of all parts remembered; and words are encoded
    without character offsets."""
    e, made, index_in = token_files.Encoder(PATH), [], word_bpe.pc.index_in
    monkeypatch.setattr(word_bpe.pc, "index_in", lambda x, value_set: made.append(len(value_set)) or index_in(x, value_set=value_set))
    monkeypatch.setattr(e, "model", type("Model", (), {"encode_batch_fast": e.model.encode_batch_fast})())
    texts = [" ".join(f"w{chr(97 + i)}{chr(97 + j)}" for j in range(26)) for i in range(26)]
    for t in [" ".join(texts), "one waa two wab", "one"]:
        assert np.frombuffer(b"".join(next(e.of_texts([t]))), "<u4").tolist() == ids(t)
    assert made[1:] == [4, 1]


def test_words_end_where_their_bytes_do(monkeypatch):
    e = token_files.Encoder(PATH)
    words = ["a", " été", "naïveté", " Straße", "x" * 300, " y"]
    got, sizes = e._word_ids(words)
    assert np.split(got, np.cumsum(sizes)[:-1])[1].tolist() == ids(" été")
    assert [x.tolist() for x in np.split(got, np.cumsum(sizes)[:-1])] == [ids(w) for w in words]
    e.token_bytes = np.ones_like(e.token_bytes)  # as if bytes were missing: the library says where words end
    again, same = e._word_ids(words)
    assert again.tolist() == got.tolist() and same.tolist() == sizes.tolist()


@pytest.fixture(scope="module")
def written(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(10**6), rnd.choice(ODD) + " w" * rnd.randrange(90), "f", 1) for _ in range(300)]
    rows += [(None, "null id", "f", 1), (7, None, "f", 1), (7, None, "f", 1), (7, "", "f", 1), (-3, "z " * 3000, "f", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string, first long").repartition(5)
    path = f"{scratch(spark, 'tokens-')}/out"
    token_files.write_token_files(df, PATH, path)
    return rows, path


def test_round_trip(spark, written):
    rows, path = written
    got = token_files.checksums(token_files.read_token_files(spark, path)).collect()
    crc = lambda i: zlib.crc32(np.array(i, "<u4").tobytes())
    want = sorted(((d, len(i), crc(i)) for d, i in ((d, ids(t) + [2]) for d, t, _, _ in rows)), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order])[:-1].tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in in_order]
    assert order == sorted(order)


def test_layout(written):
    files = sorted(ds.dataset(written[1]).files)
    assert files
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                kind = "DELTA_BINARY_PACKED" if not col.path_in_schema.startswith("ids") else "RLE_DICTIONARY"
                assert kind in col.encodings, (col.path_in_schema, col.encodings)
                assert col.has_offset_index


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    path = f"{scratch(spark, 'tokens-')}/out"
    token_files.write_token_files(df, PATH, path)
    assert token_files.checksums(token_files.read_token_files(spark, path)).count() == 0
