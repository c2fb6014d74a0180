"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

In byte-level BPE a token sequence is the encoding of its bytes exactly if every two
neighbouring tokens are (encoding the two alone gives the two back). So the last token of
the encoding of a prefix is the one token that ends there and fits the last token of the
prefix before it, and its count is that prefix's count plus one. One pass over a word
gives the count at each of its prefixes; nothing is encoded twice.

The pre-tokenizer cuts a text into words that are encoded alone. A prefix of the text has
the words of the text, the last of them cut, but for three cases that are handled where
they arise: a run of white space at the end of a prefix is one word; a cut contraction
('r of 're) is an apostrophe and a letter; a cut special string is plain text.

Words repeat, so a task keeps the counts of the parts and words it has seen, within a
bound. The same counts answer budget questions: how many tokens a text has, which is its
longest prefix within a budget, and how many tokens any prefix has.

Defined cases: a null text is the empty text with 0 tokens; special strings inside a text
count as the library counts them by default, one token; a prefix ends between characters;
very long texts are processed whole; repeated rows are answered alike; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import byte_bpe

LIMIT = 512
#: remembered words and pairs of tokens
WORDS, PAIRS = 100_000, 300_000
#: texts that are decoded at once
ROWS = 256
#: words whose counts are remembered have at most this many bytes
WORD_BYTES = 64
#: a line feed in the vocabulary's alphabet
LINE_END = "\u010a"
_CONTRACTION = re.compile("'(?:re|ve|ll)")


def packed(counts: Sequence[int]) -> Sequence[int]:
    """Small counts take one byte each."""
    return bytes(counts) if counts[-1] < 256 and max(counts) < 256 else tuple(counts)


class PrefixCounter:
    """Prefix token counts of words and parts for one byte-level BPE vocabulary file.

    Tokens are numbered by age: the single bytes, then the result of every merge in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = {a + b for a, b in merges}
        single = sorted(t for t in spec["model"]["vocab"] if len(t) == 1)
        if len(made) != len(merges) or made & set(single):
            raise ValueError("every merge must make a token of its own")
        number = {t: i for i, t in enumerate(single)}
        number.update((a + b, len(single) + i) for i, (a, b) in enumerate(merges))
        self.singles = len(single)
        self.halves = [(-1, -1)] * len(single) + [(number[a], number[b]) for a, b in merges]
        self.merge = {a << 20 | b: self.singles + i for i, (a, b) in enumerate(self.halves[self.singles:])}
        self.fits: dict[int, bool] = {}
        self.words: dict[str, bytes | tuple[int, ...]] = {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")"
                                      if self.special else "(?!)")
        self.tokens = ahocorasick.Automaton()
        for t, i in number.items():  # tokens that encode to themselves
            if i < self.singles or self.apart(*self.halves[i], i):
                self.tokens.add_word(t, (len(t), i))
        self.tokens.make_automaton()

    def apart(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge older than ``limit`` joins the bytes at the border of two tokens.

        The tokens' own merges are undone from the youngest, so that at each step the two
        pieces at the border are those that stood there when an older merge had its turn.
        Of equal merges the left one is done first.
        """
        while True:
            if self.merge.get(a << 20 | b, limit) < limit:
                return False
            if a > b and a >= self.singles:
                limit, a = min(limit, a), self.halves[a][1]
            elif b >= self.singles:
                limit, b = min(limit, b + 1), self.halves[b][0]
            else:
                return True

    def word(self, w: str) -> Sequence[int]:
        """Token counts of the prefixes of 0 .. len(w) bytes of a word (given in the
        vocabulary's alphabet of one character for each byte)."""
        known = self.words.get(w)
        if known is not None:
            return known
        fits = self.fits
        if len(fits) > PAIRS:
            fits.clear()
        count, last = [0] * (len(w) + 1), [-1] * (len(w) + 1)
        for end, (size, token) in self.tokens.iter(w):  # every token that ends at ``end``
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                pair = last[start] << 20 | token
                ok = fits.get(pair)
                if ok is None:
                    ok = fits[pair] = self.apart(last[start], token, 1 << 20)
                if not ok:
                    continue
            last[end], count[end] = token, count[start] + 1
        counts = packed(count)
        if len(w) <= WORD_BYTES:
            if len(self.words) >= WORDS:
                self.words.clear()
            self.words[w] = counts
        return counts

    def parts(self, parts: list[str], lead: str, known) -> list[Sequence[int]]:
        """Counts of many parts of texts; those without special cases are cut in one call."""
        texts = [p if p[:1] == "\n" else lead + p for p in parts]
        out: dict[str, Sequence[int]] = {}
        lines = [t for t in texts if "'" not in t and "|" not in t and byte_bpe.one_line(t)]
        if self.special and any("|" not in s for s in self.special):
            lines = [t for t in lines if not any(s in t for s in self.special)]
        words = iter(self.cut("\n".join([*lines, ""])) if lines else ())
        for t in lines:
            counts, (w, _) = [0], next(words)
            while w != LINE_END:
                base = counts[-1]
                counts += [base + c for c in self.word(w)[1:]] if base else self.word(w)[1:]
                w, _ = next(words)
            out[t] = packed(counts)
        return [out[t] if t in out else packed(self.part(t)) for t in texts]

    def _plain(self, text: str) -> list[int]:
        """Counts at 0 .. n bytes of a text without special strings."""
        counts, runs = [0], []
        at = 0
        for w, (start, end) in self.cut(text):
            base, own = counts[-1], self.word(w)
            piece = text[start:end]
            counts.extend([base + c for c in own[1:]])
            if _CONTRACTION.fullmatch(piece):
                counts[at + 2] = base + self.word(w[0])[-1] + self.word(w[1])[-1]
            if piece[0] in byte_bpe.WHITE:
                runs.append((start, at, piece, w))
            at += len(w)
        # a prefix that ends in white space has the whole run as its last word
        i = 0
        while i < len(runs):
            start, first, piece, w = runs[i]
            run, spaces, j = w, piece, i
            while not spaces.strip(byte_bpe.WHITE) and j + 1 < len(runs) and runs[j + 1][0] == start + len(spaces):
                j += 1
                run, spaces = run + runs[j][3], spaces + runs[j][2]
            k = len(spaces) - len(spaces.lstrip(byte_bpe.WHITE))
            white = run[:len(spaces[:k].encode())]
            if len(white) > 1:
                base = counts[first]
                for b, c in enumerate(self.word(white)):
                    counts[first + b] = base + c
            i = j + 1
        return counts

    def part(self, text: str) -> list[int]:
        """Counts at 0 .. n bytes of a text; only ends of characters are meaningful."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        counts, before = [0], ""
        for piece in self.special_cut.split(text):
            base = counts[-1]
            if piece in self.special:
                # inside the string a prefix is plain text, joined to what stands before
                tail = self._plain(before + piece)
                begin = len(before.encode())
                start = base - (self._plain(before)[-1] if before else 0)
                counts.extend([start + c for c in tail[begin + 1:-1]] + [base + 1])
                before = ""
            else:
                counts.extend([base + c for c in self._plain(piece)[1:]])
                before = piece
        return counts


_COUNTERS: dict[str, byte_bpe.ByParts] = {}


def counter(path: str) -> byte_bpe.ByParts:
    """Prefix counts of the parts of texts (one counter per process)."""
    if path not in _COUNTERS:
        of = PrefixCounter(path)
        _COUNTERS[path] = byte_bpe.ByParts(of.parts)
    return _COUNTERS[path]


class PrefixTable:
    """Token counts at the prefixes of one text."""

    def __init__(self, text: str, parts: list[Sequence[int]]):
        self.text = text
        self.parts = parts
        self.base = [0, *accumulate(p[-1] for p in parts)]
        self.starts = [0, *accumulate(len(p) - 1 for p in parts)]

    @property
    def n_tokens(self) -> int:
        return self.base[-1]

    def counts(self) -> list[int]:
        """Token count at every byte of the text (meaningful at ends of characters)."""
        out = [0]
        for p, b in zip(self.parts, self.base):
            out.extend(b + c for c in p[1:])
        return out

    def fits(self, budget: int) -> int:
        """Bytes of the longest prefix, between characters, with at most ``budget`` tokens."""
        if self.n_tokens <= budget:
            return self.starts[-1]
        raw = self.text.encode("utf-8", "replace")
        for k in range(len(self.parts) - 1, -1, -1):
            if self.base[k] <= budget:
                p, start = self.parts[k], self.starts[k]
                for i in range(len(p) - 1, 0, -1):
                    here = start + i
                    if self.base[k] + p[i] <= budget and (
                            here == len(raw) or raw[here] & 0xC0 != 0x80):
                        return here
        return 0


def tables(texts: list[str], vocabulary: str) -> Iterator[PrefixTable]:
    return map(PrefixTable, texts, counter(vocabulary)(texts))


def prefix_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, counts): the token count at every byte of every text, 0 first."""
    d = docs.select("doc_id", "text")
    schema = T.StructType([d.schema["doc_id"], T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                some = b.slice(i, ROWS)
                got = [t.counts() for t in tables(byte_bpe.texts_of(some.column(1)), vocabulary)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(got, pa.list_(pa.int32()))], names=["doc_id", "counts"])

    return d.mapInArrow(run, schema)


def budgets(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_bytes): ``fit_bytes`` is the length of
    the longest prefix with at most ``limit`` tokens. The tables stay inside the task."""
    d = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0))
                    .cast("long").alias("n_bytes"))
    schema = T.StructType([d.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType()),
                           T.StructField("fit_bytes", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fit = [], []
            for i in range(0, b.num_rows, ROWS):
                for t in tables(byte_bpe.texts_of(b.column(1).slice(i, ROWS)), vocabulary):
                    n.append(t.n_tokens)
                    fit.append(t.fits(limit))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64())],
                names=schema.names)

    return d.mapInArrow(run, schema)
