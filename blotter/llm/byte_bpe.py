"""Whole texts through a byte-level BPE vocabulary file, word by word.

The pre-tokenizer of the byte-level BPE files never joins what stands before and after a
single space between two characters that are not white space: the space starts a token
of its own word. A text can therefore be cut at such spaces, and the tokens of the whole
text are the tokens of the parts in a row. Words repeat, so a task encodes each part once
and looks it up afterwards; the number of parts it remembers is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa

#: white space that cannot be told from the plain text by looking for ASCII pairs
_RARE = re.compile("[" + "".join(map(chr, [0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680,
                                             *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                                             0x205F, 0x3000])) + "]")
_PAIRS = ("  ", " \n", "\n ", "\n\n", "\t", "\r")
SAFE = re.compile(r"(?<=\S) (?=\S)")

#: byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow 255
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_ALPHABET = {b: b for b in _PRINTED} | {
    b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

MEMORY = 400_000
#: parts longer than this are not remembered
LONGEST = 64
#: stands for no part; no text can hold it
EMPTY = object()
#: white space as the vocabulary files' patterns have it (U+001C..U+001F are none)
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: characters of the texts that are cut at once
CHARS = 3_000_000


def parts(text: str) -> list[str]:
    """The parts of a text. Every part but the first follows a cut space, unless it
    begins with a line feed, which then stands between two characters that are not white
    space and is a token of its own."""
    if (text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or any(p in text for p in _PAIRS)
            or _RARE.search(text)):
        return SAFE.split(text)
    return text.replace("\n", " \n").split(" ")


class Remembered:
    """Values of parts, with a bounded memory of two generations.

    ``of(parts, lead, known)`` gives the values of new parts; ``lead`` is what stands
    before a part that does not begin with a line feed, ``known(part)`` a remembered
    value or None.
    """

    def __init__(self, of: Callable[[list[str], str, Callable], list], lead: str):
        self.of, self.lead, self.new, self.old = of, lead, {}, {}

    def known(self, part: str):
        return self.new.get(part) or self.old.get(part)

    def learn(self, wanted: set[str]) -> dict:
        """A dict that holds at least every wanted part."""
        if len(self.new) > MEMORY:
            self.old, self.new = self.new, {}
        short, long_ = [], []
        for w in wanted.difference(self.new):
            if w in self.old:
                self.new[w] = self.old[w]
            else:
                (short if len(w) <= LONGEST else long_).append(w)
        if short:
            self.new.update(zip(short, self.of(short, self.lead, self.known)))
        if long_:  # for this batch only
            return {**{w: self.new[w] for w in wanted if w in self.new},
                    **dict(zip(long_, self.of(long_, self.lead, self.known)))}
        return self.new


class ByParts:
    """Applies a function of parts to whole texts."""

    def __init__(self, of: Callable[[list[str], str, Callable], list]):
        self.first, self.later = Remembered(of, ""), Remembered(of, " ")

    def __call__(self, texts: list[str]) -> Iterator[list]:
        """For every text the values of its parts, in order."""
        i = 0
        while i < len(texts):
            j, held = i, 0
            while j < len(texts) and held < CHARS:
                held += len(texts[j])
                j += 1
            cut = [parts(t) for t in texts[i:j]]
            heads = [c[0] for c in cut]
            first = self.first.learn(set(heads))
            for c, head in zip(cut, heads):
                c[0] = c[-1] if len(c) > 1 else EMPTY
            wanted = set().union(*cut)
            wanted.discard(EMPTY)
            later = self.later.learn(wanted)
            for c, head in zip(cut, heads):
                if len(c) == 1:
                    yield [first[head]]
                else:
                    values = list(map(later.__getitem__, c))
                    values[0] = first[head]
                    yield values
            i = j


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null is the empty text."""
    return ["" if t is None else t.decode("utf-8", "replace")
            for t in column.cast(pa.binary()).to_pylist()]


def one_line(part: str) -> bool:
    """Whether a part, a leading space aside, is one run without white space."""
    bare = part[1:] if part[:1] == " " else part
    return bare.split() == [bare]
