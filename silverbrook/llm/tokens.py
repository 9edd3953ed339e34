"""Token ids of texts, by a byte-level tokenizers file whose words can be encoded on their own.

A byte-level BPE cuts a text into words by a pattern and merges within words
only, so a word has the same ids wherever it stands. Texts are cut before spaces
and, where no other white space touches them, before line ends into units, and
the ids of a unit are remembered; only units that a worker has not met go to
the library. Arrow tells the distinct units of some texts and puts their ids back
in the order of the texts, so each is looked up once for all its places. New units of letters, nearly all of them, go there many at a time
as one text, in which each stays a word of its own; where its ids end follows
from the bytes that each id stands for.

What the shortcut does not cover is encoded as a whole by the library: texts
with two spaces in a row (a run of white space may cross units), with the text
of a special token, or with characters whose class may differ between versions
of Unicode. Every id comes from the tokenizers library either way.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Units that are remembered: some 200 MB in a worker. Beyond it the first half is kept.
UNITS = 1_000_000
#: Characters of text encoded at a time.
CHUNK_CHARS = 2_000_000
#: New words that go to the library as one text.
WORDS_AT_ONCE = 1000

# Fixed value: the word pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Up to U+07FF, and common punctuation and currency signs: their classes are settled.
_MARKS = string.punctuation
_UNSETTLED = regex.compile("[^\u0000-\u07ff\u2000-\u20bf]")


class Encoder:
    """Ids of texts as arrays of ``dtype`` (two bytes where the vocabulary allows it)."""

    def __init__(self, path: str, units: int = UNITS) -> None:
        self.remembered = units
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 2**16 else "<u4")
        # One character of a byte-level token stands for one byte.
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.widths[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(PATTERN)
        #: The ids of units: those that follow a space without it, those that follow a line end with it.
        self.units: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        data = np.array(list(chain.from_iterable(found)), self.dtype).tobytes()
        ends = np.cumsum([0, *map(len, found)]) * self.dtype.itemsize
        return [data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]

    def _cut(self, text: str) -> tuple[str, str | None] | None:
        """The first unit and the others, a space between them; None when it must be encoded as a whole."""
        if "  " in text or " \n" in text or any(s in text for s in self.specials):
            return None
        if not text.isascii() and _UNSETTLED.search(text) is not None:
            return None
        lines = text.split("\n")
        if len(lines) > 1:
            if not lines[-1]:
                lines.pop()
            if all(line and not line[0].isspace() and not line[-1].isspace() for line in lines):
                text = text.replace("\n", " \n")
        first, space, others = text.partition(" ")
        return first, others if space else None

    def _words(self, words: list[str], before: str) -> Iterator[bytes]:
        """The ids of words of letters with a character before each: in the first id, or as one."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            text = before + before.join(words[at : at + WORDS_AT_ONCE])
            data = self._library([text])[0]
            raw = np.frombuffer(text.encode(), np.uint8)
            # A word's last id is the one that ends where the word's bytes end.
            word_ends = np.append(np.flatnonzero(raw == ord(before))[1:], len(raw))
            id_ends = np.cumsum(self.widths[np.frombuffer(data, self.dtype)])
            ends = ((np.searchsorted(id_ends, word_ends) + 1) * self.dtype.itemsize).tolist()
            yield from map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))

    def _learn(self, units: list[str]) -> None:
        """Remember new units: words after a space or a line end, with marks after them, or anything else."""
        after_space = set(filter(str.isalpha, units))
        after_line, marked, others = set(), [], []
        for unit in filterfalse(str.isalpha, units):
            # Marks in a row are a word of the pattern.
            word = unit.rstrip(_MARKS)
            if word.isalpha():
                after_space.add(word)
            elif word[:1] == "\n" and word[1:].isalpha():
                after_line.add(word)
            else:
                others.append(unit)
                continue
            if len(word) < len(unit):
                marked.append((unit, word, unit[len(word) :]))
        # A word may be known where the word with its marks is new.
        words = list(after_space.difference(self.units))
        self.units.update(zip(words, self._words(words, " "), strict=True))
        words = list(after_line.difference(self.units))
        self.units.update(zip(words, self._words([w[1:] for w in words], "\n"), strict=True))
        cut = [self.pattern.findall(u if u[:1] == "\n" else " " + u) for u in others]
        pieces = list({marks for _, _, marks in marked}.union(*cut))
        known = dict(zip(pieces, self._library(pieces), strict=True))
        self.units.update([(u, self.units[word] + known[marks]) for u, word, marks in marked])
        self.units.update([(u, b"".join([known[w] for w in found])) for u, found in zip(others, cut, strict=True)])

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.units) > self.remembered:
            # What was met first is met most.
            self.units = dict(islice(self.units.items(), self.remembered // 2))
        cuts = [self._cut(text) for text in texts]
        easy = [cut for cut in cuts if cut is not None]
        # What comes first stands after nothing.
        whole = map(bytes.__add__, self._library([first for first, _ in easy]), self._after([x for _, x in easy]))
        hard = iter(self._library([t for t, cut in zip(texts, cuts, strict=True) if cut is None]))
        return [next(hard) if cut is None else next(whole) for cut in cuts]

    def _after(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of what follows the first space of each text; a null has none."""
        units = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        places = units.flatten().dictionary_encode()
        distinct = places.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not distinct:
            return iter([b""] * len(texts))
        found = list(map(self.units.get, distinct))
        new = [unit for unit, ids in zip(distinct, found, strict=True) if ids is None]
        if new:
            self._learn(new)
            found = [self.units[unit] if ids is None else ids for unit, ids in zip(distinct, found, strict=True)]
        _, ends, data = pa.array(found, pa.large_binary()).take(places.indices).buffers()
        ends = np.frombuffer(ends, np.int64)[units.offsets.to_numpy()].tolist()
        return map(data.to_pybytes().__getitem__, map(slice, ends, ends[1:]))

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a few texts are held at a time."""
        chunk: list[str] = []
        size = 0
        for text in texts:
            chunk.append(text)
            size += len(text)
            if size >= CHUNK_CHARS:
                yield from (np.frombuffer(x, self.dtype) for x in self._encode(chunk))
                chunk, size = [], 0
        yield from (np.frombuffer(x, self.dtype) for x in self._encode(chunk))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, units: int = UNITS) -> Encoder:
    """The worker's encoder for a tokenizer file, kept from task to task; it remembers so many units."""
    if (path, units) not in _ENCODERS:
        _ENCODERS[path, units] = Encoder(path, units)
    return _ENCODERS[path, units]
