"""Token ids as Parquet list columns, written in document order and read selectively.

One row per document: ``doc_id``, ``first`` (its first id's place in the file),
``n_tokens`` and the list ``ids``. Files follow each other in ascending doc_id order.

* ids are dictionary-encoded: the dictionary of a vocabulary is small, and an id then takes
  about as many bits as the ids of its row group need;
* the numeric metadata columns are delta-encoded (Parquet's version 2 pages);
* row groups are ``ROW_GROUP`` bytes and pages ``PAGE`` bytes, with Parquet's column and
  offset indexes, so that a reader of some documents or of the metadata alone touches
  few pages.

The documents are range-sorted as texts, then encoded in place: the ids never go through
a shuffle. A range of doc_ids is one task, and rows of one doc_id are spread by their
text's hash. The place of a document's ids in the whole corpus is its place in the file
plus the ids of all files before, which takes a sum over the narrow metadata column.

Defined cases: a null text is the empty text, which has the end id alone; null doc_ids
come first; rows with equal doc_id are ordered by their text's hash, rows that repeat
exactly are interchangeable; an empty table gives files without rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import byte_bpe, word_bpe

END_ID = 2
#: separates the parts of a text; texts that hold it are not cut
_CUT = "\x01"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: white space that is more than single spaces and line feeds between other characters
_ODD = ("^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b\x0c\r\x01\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a"
        "\u2028\u2029\u202f\u205f\u3000]")
#: marks that are a word of their own between letters or digits and those, a space or a line feed
_MARKS = (".", ",")
_CROWDED = f"(?:^|[^0-9{_LETTERS}])[.,]|[.,][^ \n0-9{_LETTERS}]"
_PLAIN = f"^ ?[{_LETTERS}]+$"
ROW_GROUP, PAGE = 32 << 20, 64 << 10
LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#first": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "snappy",
}

_ENCODERS: dict[str, "Encoder"] = {}


class Encoder(word_bpe.PartEncoder):
    """Little-endian 32-bit ids by a byte-level vocabulary file. Its pre-tokenizer never joins
    what stands before and after a single space or line feed between two other characters (a space
    starts the next word, a line feed is a word), so texts are cut there."""

    safe = byte_bpe.SAFE

    def __init__(self, path: str):
        super().__init__(path, "<u4")
        self.alphabet = {**byte_bpe.BYTE_ALPHABET, 0: 0x20}
        vocabulary = self.tokenizer.get_vocab()
        # bytes of each token: one character of the alphabet stands for one
        self.token_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        odd = pc.match_substring_regex(texts, _ODD)
        apart = texts
        for m in _MARKS:
            apart = pc.replace_substring(apart, m, _CUT + m)
        even = pc.if_else(pc.match_substring_regex(texts, _CROWDED), texts, apart).filter(pc.invert(odd))
        even = pc.replace_substring(pc.replace_substring(even, "\n", _CUT + "\n" + _CUT), " ", _CUT + " ")
        cut = pc.split_pattern(even, _CUT)
        if len(even) == len(texts):
            return cut
        rest = [[t] if _CUT in t else (_CUT + " ").join(byte_bpe.SAFE.split(t)).split(_CUT)
                for t in texts.filter(odd).to_pylist()]
        is_odd, place = odd.to_numpy(zero_copy_only=False), np.empty(len(texts), np.int64)
        place[~is_odd], place[is_odd] = np.arange(len(even)), np.arange(len(even), len(texts))
        return pa.concat_arrays([cut, pa.array(rest, cut.type)]).take(pa.array(place))

    def _plain(self, parts: pa.Array) -> pa.Array:
        return pc.match_substring_regex(parts, _PLAIN)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = "\0".join(words).encode()
        line = raw.decode("latin-1").translate(self.alphabet)
        # without character offsets, which cost more than the ids; words end where their bytes do
        (got,) = self.model.encode_batch_fast([line], add_special_tokens=False)
        ids = np.array(got.ids, self.dtype)
        gaps = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) == 0), len(raw))
        ends, at = np.cumsum(self.token_bytes[ids]), gaps - np.arange(len(gaps))
        upto = np.searchsorted(ends, at, "right")
        if (ends[upto - 1] == at).all() and upto[-1] == len(ids):
            return ids, np.diff(upto, prepend=0)
        got = self.model.encode(line, add_special_tokens=False)  # a byte is missing in the vocabulary
        return np.array(got.ids, self.dtype), np.bincount(np.array(got.word_ids), minlength=len(words))

    def of_texts(self, texts: list[str]) -> Iterator[list[bytes]]:
        """The ids of every text, as a list of one or more runs."""
        for ids, ends in self(pa.array(texts, pa.string())):
            yield from ([x.tobytes()] for x in np.split(ids, ends[:-1]))


def encoder(path: str) -> Encoder:
    """One encoder per process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Rows of the file format, range-sorted by doc_id."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("h", F.xxhash64("text"))
    ordered = d.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    schema = T.StructType([d.schema["doc_id"], T.StructField("first", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place = encoder(vocabulary), 0
        for b in batches:
            done = 0
            for ids, ends in encode(b.column(1).cast(pa.string())):
                ends = ends + np.arange(1, len(ends) + 1)
                rows = np.insert(ids, ends - np.arange(1, len(ends) + 1), END_ID).astype("<i4")
                offsets = np.concatenate([[0], ends])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(ends)), pa.array(place + offsets[:-1]), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rows))],
                    names=["doc_id", "first", "n_tokens", "ids"])
                done += len(ends)
                place += int(offsets[-1])

    return ordered.select("doc_id", "text").mapInArrow(run, schema)


def write_token_files(docs: DataFrame, vocabulary: str, path: str) -> None:
    w = tokenized(docs, vocabulary).write.mode("errorifexists")
    w.options(**LAYOUT).parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """The rows of the files, with the number of the file they stand in."""
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return spark.read.parquet(path).select("*", number.alias("file"))


def with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids of all documents before, to rows that carry
    ``file`` and ``first``; reads only the token counts of the files."""
    # one row per file: the sum over all files before it runs in one task
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = (files.groupBy("file").agg(F.sum("n_tokens").alias("ids_in_file"))
             .select("file", F.coalesce(F.sum("ids_in_file").over(before), F.lit(0)).alias("base")))
    return (rows.join(bases, "file").withColumn("start", F.col("base") + F.col("first"))
            .drop("base", "file", "first"))


def checksums(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), from the ids as read."""
    d = files.select("doc_id", "file", "first", "ids")
    schema = T.StructType([d.schema["doc_id"], T.StructField("file", T.LongType()),
                           T.StructField("first", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            raw = memoryview(np.asarray(lists.values).astype("<u4").tobytes())
            at = lists.offsets.to_numpy().astype(np.int64)
            crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(at)),
                 pa.array(crc, pa.int64())], names=schema.names)

    return with_start(d.mapInArrow(run, schema), files).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
