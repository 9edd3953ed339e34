"""Token counts of texts, by looking up the lengths of their pre-tokens in two tiers.

For a vocabulary that drops white space, no token crosses it: a text has as many
tokens as its pieces between ASCII white space have together. The lengths of the
most frequent pieces are kept in a table that is sent to every task once; what
the table lacks is taken from a cache of the Python worker, and what the cache
lacks is encoded by the library and remembered there. Texts are counted where
they are read: neither a text nor a pre-token is shuffled.

A piece of ASCII characters that is met for the first time is cut further, at
the bounds that the vocabulary's own pattern sets, so that ``word,`` and
``(word)`` share the length of ``word``. Any other piece goes to the library as
it is. Both rules are tried out on the vocabulary before they are relied on.

The table changes the time only, never a count. It holds at most ``FREQUENT``
pieces of at most ``LONGEST`` bytes, under 2 MB together; they are the most
frequent ones of a random sample of about ``SAMPLE`` texts, of which each task
hands the driver at most ``PER_TASK`` pieces. The cache holds at most ``CACHED``
pieces of at most ``LONGEST`` bytes and is emptied when it is full. A long text
is counted in slices of ``SLICE`` bytes, cut at white space.

Defined cases: a null or empty text, or one of white space alone, has no tokens
(and 0 bytes where null); special strings inside a text are what the library
takes them for; bytes that are no UTF-8 count as U+FFFD; repeated rows, and
rows without doc_id, are counted like any others; no documents give no rows;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Bounds of the table that every task gets, and of the sample it is drawn from.
FREQUENT = 50_000
LONGEST = 32
SAMPLE = 1000
PER_TASK = 5000
#: Pieces a worker remembers, and pieces and bytes that go to the library at a time.
CACHED = 400_000
AT_ONCE = 2000
SLICE = 1_000_000

_COUNTS = "doc_id long, n_bytes long, n_tokens long"
# Fixed value: how the vocabulary's pattern cuts lower-case ASCII characters.
_PATTERN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# What the two rules are tried out on.
_PROBES = ("It's", "(Don't!)", "x86-64,", "'Twas...", "café", "42", "WE'RE", "中文。", "--'d'S")


def load(path: str) -> Tokenizer:
    """The vocabulary of a file, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def library_lengths(tokenizer: Tokenizer, pieces: list[bytes]) -> list[int]:
    """The number of tokens of each piece by the library, a few at a time."""
    found: list[int] = []
    held: list[str] = []
    size = 0
    for piece in pieces:
        held.append(piece.decode("utf-8", "replace"))
        size += len(piece)
        if len(held) == AT_ONCE or size >= SLICE:
            found.extend(map(len, tokenizer.encode_batch_fast(held, add_special_tokens=False)))
            held, size = [], 0
    found.extend(map(len, tokenizer.encode_batch_fast(held, add_special_tokens=False)))
    return found


def check_vocabulary(tokenizer: Tokenizer) -> None:
    """Refuse a vocabulary whose tokens cross white space or that cuts ASCII text otherwise."""
    probes = [p.encode() for p in _PROBES]
    whole = library_lengths(tokenizer, [b" \n".join(probes), b"\t" + b"\r\n ".join(probes) + b" "])
    alone = library_lengths(tokenizer, probes)
    ascii_only = [p for p in probes if p.isascii()]
    cut = [sum(library_lengths(tokenizer, _PATTERN.findall(p.lower()))) for p in ascii_only]
    if whole != [sum(alone)] * 2 or cut != library_lengths(tokenizer, ascii_only):
        raise ValueError("the vocabulary's tokens cross white space or its own pieces")


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes that end at white space."""
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        if space is None:
            break
        yield text[at : space.start()]
        at = space.end()
    yield text[at:]


class Lengths:
    """Both tiers of a worker."""

    def __init__(self, path: str, table: tuple[bytes, bytes]) -> None:
        self.tokenizer = load(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # No piece holds white space, so the keys lie one after the other.
        self.frequent = dict(zip(table[0].split(), np.frombuffer(table[1], "<u2").tolist(), strict=True))
        self.cache: dict[bytes, int] = {}

    def _cut(self, piece: bytes) -> list[bytes]:
        if piece.isascii() and not any(s in piece for s in self.specials):
            return _PATTERN.findall(piece.lower())
        return [piece]

    def _learn(self, pieces: set[bytes]) -> dict[bytes, int]:
        """The lengths of pieces that neither tier has."""
        cut = {p: self._cut(p) for p in pieces}
        parts = {c for cs in cut.values() for c in cs}
        new = [c for c in parts if c not in self.frequent and c not in self.cache]
        known = dict(zip(new, library_lengths(self.tokenizer, new), strict=True))

        def length(part: bytes) -> int:
            found = known.get(part)
            if found is None:
                found = self.frequent.get(part)
            return self.cache[part] if found is None else found

        lengths = {p: sum(map(length, cs)) for p, cs in cut.items()}
        if len(self.cache) + len(lengths) + len(known) > CACHED:
            self.cache.clear()
        remembered = {p: n for p, n in (known | lengths).items() if len(p) <= LONGEST}
        if len(remembered) <= CACHED:
            self.cache.update(remembered)
        return lengths

    def count(self, texts: list[bytes | None]) -> list[int]:
        totals = [0] * len(texts)
        missing: list[tuple[int, bytes]] = []

        def resolve() -> None:
            lengths = self._learn({piece for _, piece in missing})
            for row, piece in missing:
                totals[row] += lengths[piece]
            missing.clear()

        for row, text in enumerate(texts):
            for part in slices(text or b""):
                pieces = part.split()
                lengths = list(map(self.frequent.get, pieces))
                if None in lengths:
                    rest = [p for p, n in zip(pieces, lengths, strict=True) if n is None]
                    totals[row] += sum(n for n in lengths if n is not None)
                    lengths = list(map(self.cache.get, rest))
                    missing.extend((row, p) for p, n in zip(rest, lengths, strict=True) if n is None)
                    lengths = [n for n in lengths if n is not None]
                totals[row] += sum(lengths)
                if len(missing) >= AT_ONCE:
                    resolve()
        resolve()
        return totals


#: The tiers of this worker, by file and table; they are kept from task to task.
_TIERS: dict[tuple[str, tuple[bytes, bytes]], Lengths] = {}


def _tiers(path: str, table: tuple[bytes, bytes]) -> Lengths:
    if (path, table) not in _TIERS:
        _TIERS.clear()  # a worker holds one table
        _TIERS[path, table] = Lengths(path, table)
    return _TIERS[path, table]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's most frequent pieces, one after the other, and how often each stands there."""
    seen: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            for part in slices(text or b""):
                seen.update(p for p in part.split() if len(p) <= LONGEST)
                if len(seen) > 10 * PER_TASK:
                    seen = Counter(dict(seen.most_common(PER_TASK)))
    top = seen.most_common(PER_TASK)
    if top:
        counts = np.array([n for _, n in top], "<i8").tobytes()
        columns = [pa.array([b" ".join(p for p, _ in top)], pa.binary()), pa.array([counts], pa.binary())]
        yield pa.record_batch(columns, ["pieces", "counts"])


def frequent_lengths(docs: DataFrame, path: str, size: int = FREQUENT) -> tuple[bytes, bytes]:
    """The table: pieces joined by spaces, and their lengths as little-endian unsigned 16-bit integers."""
    tokenizer = load(path)
    check_vocabulary(tokenizer)
    rows = docs.count()
    drawn = docs.select(F.col("text").cast("string")).sample(min(1.0, SAMPLE / max(rows, 1)), seed=12)
    seen: Counter[bytes] = Counter()
    for row in drawn.mapInArrow(_sampled, "pieces binary, counts binary").toLocalIterator():
        pieces = bytes(row["pieces"]).split()
        seen.update(dict(zip(pieces, np.frombuffer(row["counts"], "<i8").tolist(), strict=True)))
    top = sorted(seen, key=lambda p: (-seen[p], p))[:size]
    lengths = library_lengths(tokenizer, top)
    return b" ".join(top), np.array(lengths, "<u2").tobytes()


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = _tiers(path, table.value)
        for batch in batches:
            totals = tiers.count(batch.column(2).cast(pa.binary()).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(totals, pa.int64())]
            yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), size, text).mapInArrow(count, _COUNTS)
