"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1/-1 drawn from its code point. A letter trigram is
bound into one vector by multiplying its letters' vectors, rotated by two, one and no
places, so that order counts. The trigrams of the lower-cased words of a text (with a mark
at either end of a word) are bundled by adding their vectors. The bundle of all labelled
training texts of a language is its prototype, and a text gets the language whose
prototype has the largest cosine with the text's own bundle.

Training is one pass: each task adds up the bundles of its rows, and the sums of the tasks
(languages x dimensions numbers each) are added by a grouped sum. Only the prototypes go
to the driver; their size is languages x ``DIMENSIONS``. Prediction is a map over the
rows. Sums are of integers, so the result does not depend on partitions or order.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; rows without
label are not learned from; more than ``LANGUAGES`` labels raise an error; without any
label every text is ``und``; equal cosines go to the first language by name; a negative
cosine gives score 0; a null doc_id is not held out; repeated rows count as often as they
stand; texts of any script take bounded memory; other columns are carried or ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSIONS = 1024
SEED = 9
UNKNOWN = "und"
#: characters bundled at once, texts bundled at once, largest table of letter triples
CHARS, TEXTS, TRIPLES = 500_000, 256, 4_000_000
#: distinct trigrams bound at once, letters whose vectors are remembered
BOUND, LETTERS = 4096, 4096
#: labels that can be learned; a column with more is refused
LANGUAGES = 1000


def held_out(doc_id: Column) -> Column:
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


_LETTERS: dict[int, np.ndarray] = {}


def letter_vector(code: int) -> np.ndarray:
    """The +1/-1 vector of a code point; 0 is the mark at the ends of words."""
    if code not in _LETTERS:
        if len(_LETTERS) >= LETTERS:
            _LETTERS.clear()
        bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS)
        _LETTERS[code] = (2 * bits - 1).astype(np.float32)
    return _LETTERS[code]


def _ranked(values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (all below ``end``) and the rank of each value; by a table if small."""
    if end > TRIPLES:
        return np.unique(values, return_inverse=True)
    there = np.zeros(end, bool)
    there[values] = True
    distinct = np.flatnonzero(there)
    rank = np.zeros(end, np.int32)
    rank[distinct] = np.arange(len(distinct))
    return distinct, rank[values]


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, trigram number) of every trigram, and the code points (n, 3) of the
    distinct trigrams."""
    joined = "\0".join(["", *texts, ""]).lower()
    raw = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    codes, at = _ranked(raw, int(raw.max()) + 1)
    letter = np.array([chr(c).isalpha() for c in codes])
    owner = np.cumsum(raw == 0) - 1
    alphabet = np.concatenate([[0], codes[letter]])
    number = np.zeros(len(codes), np.int64)
    number[letter] = np.arange(1, len(alphabet))
    x = number[at]
    keep = (x > 0) | np.concatenate([[True], x[:-1] > 0])  # one mark between two words
    x, owner = x[keep], owner[keep]
    if len(x) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 3), np.int64)
    middle = x[1:-1] > 0
    k = len(alphabet)
    triple = ((x[:-2] * k + x[1:-1]) * k + x[2:])[middle]
    distinct, which = _ranked(triple, k ** 3)
    parts = np.stack([distinct // k // k, distinct // k % k, distinct % k], axis=1)
    return owner[1:-1][middle], which, alphabet[parts]


def _bound(trigrams: np.ndarray) -> np.ndarray:
    letters, at = np.unique(trigrams, return_inverse=True)
    at = at.reshape(-1, 3)
    v = np.stack([letter_vector(int(c)) for c in letters])
    bound = v[at[:, 2]]
    for turn, letter in ((1, at[:, 1]), (2, at[:, 0])):  # the smaller of the two is turned
        bound *= np.roll(v, turn, axis=1)[letter] if len(v) < len(at) else np.roll(v[letter], turn, axis=1)
    return bound


def _bundle(texts: list[str], owners: np.ndarray, n: int) -> np.ndarray:
    """Sum of the bundles of the texts by owner (0 .. n-1)."""
    row, which, trigrams = _trigrams(texts)
    if not len(which):
        return np.zeros((n, DIMENSIONS), np.float64)
    total, owner = np.zeros((n, DIMENSIONS), np.float64), owners[row]
    for i in range(0, len(trigrams), BOUND):  # the tables of a slice take a fixed space
        some = trigrams[i:i + BOUND]
        there = slice(None) if len(some) == len(trigrams) else (which >= i) & (which < i + BOUND)
        counts = np.bincount(owner[there] * len(some) + which[there] - i, minlength=n * len(some))
        total += counts.reshape(n, len(some)).astype(np.float32) @ _bound(some)
    return total


def _pieces(text: str) -> Iterator[str]:
    """Long texts in pieces of about CHARS characters, cut between words."""
    i = 0
    while i < len(text):
        j = i + CHARS
        while j < len(text) and text[j].isalpha():
            j += 1
        yield text[i:j]
        i = j


def bundles(texts: list[str | None], owners: list[int], n: int) -> np.ndarray:
    """The hypervector of each owner: the sum over its texts, as whole numbers."""
    total = np.zeros((n, DIMENSIONS))
    batch: list[str] = []
    own: list[int] = []
    held = 0

    def flush():
        ids, local = np.unique(np.array(own), return_inverse=True)
        total[ids] += _bundle(batch, local, len(ids))
        batch.clear()
        own.clear()

    for text, o in zip(texts, owners):
        for piece in _pieces((text or "").replace("\0", " ")):
            batch.append(piece)
            own.append(o)
            held += len(piece)
            if held >= CHARS or len(batch) >= TEXTS:
                flush()
                held = 0
    if batch:
        flush()
    return total


def _texts(column: pa.Array) -> list[str | None]:
    return [None if t is None else t.decode("utf-8", "replace")
            for t in column.cast(pa.binary()).to_pylist()]


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their unit prototypes, from all rows with a label that are
    not held out. Only ``text`` and ``lang`` are learned from."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                          & ~held_out(F.col("doc_id"))).select("lang", "text")

    if labelled.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages are labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(0).to_pylist()
            names = sorted(set(langs))
            number = {x: i for i, x in enumerate(names)}
            part = bundles(_texts(b.column(1)), [number[x] for x in langs], len(names))
            for x, v in zip(names, part):
                sums[x] = sums[x] + v if x in sums else v
        for x, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                 pa.array(v.astype(np.int64))], names=["lang", "d", "v"])

    sums = (labelled.mapInArrow(run, "lang string, d int, v long")
            .groupBy("lang", "d").agg(F.sum("v").alias("v")))
    rows = sums.collect()  # languages x DIMENSIONS numbers
    names = sorted({r["lang"] for r in rows})
    p = np.zeros((len(names), DIMENSIONS))
    for r in rows:
        p[names.index(r["lang"]), r["d"]] = r["v"]
    norm = np.linalg.norm(p, axis=1, keepdims=True)
    return names, p / np.where(norm > 0, norm, 1)


def identify(rows: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """``rows`` (doc, text) or (doc with a field text) -> (doc, has_letter, lang_pred, score)."""
    schema = T.StructType([rows.schema["doc"], T.StructField("has_letter", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    inner = rows.columns == ["doc"]
    at = rows.schema["doc"].dataType.names.index("text") if inner else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column(0)
            texts = _texts(doc.field(at) if inner else b.column(1))
            letter = np.array([t is not None and any(map(str.isalpha, t.lower())) for t in texts], bool)
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for i in range(0, len(texts) if names else 0, TEXTS):
                some = texts[i:i + TEXTS]
                v = bundles(some, list(range(len(some))), len(some))
                norm = np.linalg.norm(v, axis=1)
                # rounded: the last bits of a product depend on a text's place in its batch
                cos = np.round((v @ prototypes.T) / np.where(norm > 0, norm, 1)[:, None], 12)
                best = cos.argmax(axis=1)
                for j in np.flatnonzero(letter[i:i + TEXTS]):
                    pred[i + j] = names[best[j]]
                    score[i + j] = min(1.0, max(0.0, cos[j, best[j]]))
            yield pa.RecordBatch.from_arrays([doc, pa.array(letter), pa.array(pred, pa.string()), pa.array(score)],
                                             names=["doc", "has_letter", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document."""
    names, prototypes = train(docs)
    rows = docs.select(F.struct("doc_id", held_out(F.col("doc_id")).alias("held_out")).alias("doc"),
                       "text")
    return identify(rows, names, prototypes).select("doc.*", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents with a letter in their text, all columns kept; also if no language was
    learned, or one is labelled ``UNKNOWN``."""
    names, prototypes = train(docs)
    found = identify(docs.select(F.struct("*").alias("doc")), names, prototypes)
    return found.where("has_letter").select("doc.*")
