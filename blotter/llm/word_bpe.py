"""Whole texts through a BPE vocabulary file, part by part.

Texts are split, and their parts numbered, by Arrow for a whole batch; each distinct part
is looked up once per batch, encoded if it is new, and remembered within a bound. The ids of the
texts are then gathered by the numbers of their parts.

``Encoder`` is for files of words: their normalizer and pre-tokenizer drop white space and never
join what stands before and after it, so the ids of a text are the ids of its parts between spaces
and line feeds, in a row. (``token_files.Encoder`` is for files of bytes.)
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .byte_bpe import BYTE_ALPHABET

#: a word of Latin letters that are their own normal form
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: marks that are a word of their own if only such letters, digits, spaces and line feeds stand
#: beside them (other letters may end in a mark once they are normalized)
_MARKS = (".", ",")
_BESIDE = "[^ \n0-9A-Za-zÀ-ÖØ-öø-ÿ]"
_CROWDED = f"[.,]{_BESIDE}|{_BESIDE}[.,]"
#: bytes of the texts that are split at once
BYTES = 4 << 20
#: parts that are remembered, and the longest one in bytes
MEMORY, LONGEST = 400_000, 64
#: words in one call of the library
WORDS = 1000
_ALPHABET = {**BYTE_ALPHABET, 0x20: 0x20}

_ENCODERS: dict[str, "Encoder"] = {}


class PartEncoder:
    """Ids of texts as numbers of ``dtype``, by the tokenizers library."""

    #: where a long text may be cut
    safe: re.Pattern

    def __init__(self, path: str, dtype: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(dtype or ("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"))
        # the same vocabulary for words that are already normalized, in the alphabet of bytes
        self.spec = json.loads(self.tokenizer.to_str())
        self.spec.update(normalizer=None, pre_tokenizer={"type": "WhitespaceSplit"}, post_processor=None, added_tokens=[])
        self.model = Tokenizer.from_str(json.dumps(self.spec))
        # remembered parts, their ids, and which of them were met since the last clearing
        self.parts, self.ids = pa.array([], pa.string()), self._lists([0], [])
        self.met = np.zeros(0, bool)

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """The parts of texts."""
        raise NotImplementedError

    def _plain(self, parts: pa.Array) -> pa.Array:
        """Which parts are one word to the model."""
        raise NotImplementedError

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain parts in a row, and the number of ids of each."""
        raise NotImplementedError

    def _lists(self, ends, ids) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.asarray(ids, self.dtype)))

    def _encoded(self, parts: pa.Array) -> pa.ListArray:
        """Ids of new parts."""
        plain = self._plain(parts)
        words = parts.filter(plain).to_pylist()
        flat, sizes = [], []
        for i in range(0, len(words), WORDS):  # many words in one call
            ids, n = self._word_ids(words[i:i + WORDS])
            flat.append(ids)
            sizes.append(n)
        odd = self.tokenizer.encode_batch_fast(parts.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)
        for e in odd:
            flat.append(np.array(e.ids, self.dtype))
        sizes.append(np.array([len(x) for x in flat[len(flat) - len(odd):]], np.int64))
        lists = self._lists(np.cumsum(np.concatenate([[0], *sizes])), np.concatenate([np.zeros(0, self.dtype), *flat]))
        is_plain = plain.to_numpy(zero_copy_only=False)
        order = np.empty(len(parts), np.int64)
        order[is_plain], order[~is_plain] = np.arange(len(words)), np.arange(len(words), len(parts))
        return lists.take(pa.array(order))

    def _learn(self, parts: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
        """(numbers, lists): the ids of the i-th part are lists[numbers[i]]."""
        # a table is made of the parts of this batch, which are fewer than those remembered
        of = pc.fill_null(pc.index_in(self.parts, value_set=parts), -1).to_numpy()
        at = np.full(len(parts), -1)
        at[of[of >= 0]] = np.flatnonzero(of >= 0)
        known = at >= 0
        self.met[at[known]] = True
        new = parts.filter(pa.array(~known))
        lists = pa.concat_arrays([self.ids, self._encoded(new)])
        at[~known] = np.arange(len(self.parts), len(lists))
        # new parts are remembered, unless they are long; above the bound only what was met stays
        stay = np.concatenate([self.met if len(lists) > MEMORY else np.ones(len(self.met), bool),
                               (pc.binary_length(new).to_numpy() <= LONGEST) & (len(new) <= MEMORY)])
        if len(lists) > MEMORY and stay.sum() > MEMORY:
            stay[:len(self.met)] = False
        keep = pa.array(stay)
        self.parts, self.ids = pa.concat_arrays([self.parts, new]).filter(keep), lists.filter(keep)
        self.met = np.zeros(len(self.parts), bool) if len(lists) > MEMORY else np.concatenate(
            [self.met, np.zeros(len(new), bool)])[stay]
        return at, lists

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends) of groups of texts in order: the ids of all texts of the group in a
        row, and where each text ends."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        i = 0
        while i < len(texts):
            j, held = i + 1, int(sizes[i])
            if held > BYTES:
                ids = np.concatenate([g for piece in self._pieces(texts[i].as_py())
                                      for g, _ in [self._group(pa.array([piece]))]])
                yield ids, np.array([len(ids)])
            else:
                while j < len(texts) and held + sizes[j] <= BYTES:
                    held += int(sizes[j])
                    j += 1
                yield self._group(pc.fill_null(texts.slice(i, j - i), ""))
            i = j

    def _group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = self._cut(texts)
        numbered = cut.flatten().dictionary_encode()
        number, lists = self._learn(numbered.dictionary)
        taken = lists.take(pa.array(number[numbered.indices.to_numpy()]))
        at = taken.offsets.to_numpy()[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return taken.flatten().to_numpy(), at[1:] - taken.offsets[0].as_py()

    def _pieces(self, text: str) -> Iterator[str]:
        """A long text in pieces that end where it may be cut."""
        at, step = 0, BYTES // 4
        while len(text) - at > step:
            found = self.safe.search(text, at + step)
            if not found:
                break
            yield text[at:found.start()]
            at = found.start()
        yield text[at:]


class Encoder(PartEncoder):
    """For vocabulary files of words that end in a mark of their own."""

    safe = re.compile("[ \n]")

    def __init__(self, path: str):
        super().__init__(path)
        self.ends_word = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith(self.spec["model"]["end_of_word_suffix"])

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        apart = texts
        for m in _MARKS:
            apart = pc.replace_substring(apart, m, " " + m)
        texts = pc.if_else(pc.match_substring_regex(texts, _CROWDED), texts, apart)
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def _plain(self, parts: pa.Array) -> pa.Array:
        return pc.match_substring_regex(parts, _PLAIN)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        line = " ".join(words).lower().encode().decode("latin-1").translate(_ALPHABET)
        (got,) = self.model.encode_batch_fast([line], add_special_tokens=False)  # no character offsets
        ids = np.array(got.ids, self.dtype)
        return ids, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)


def encoder(path: str) -> Encoder:
    """One encoder per process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
