"""Repeated passages by content-defined chunks.

A gear hash rolls over a text's bytes: h = (h << 1) + gear[byte]. A chunk ends
where the hash is the least of its surroundings, ``RADIUS`` bytes to either side.
That depends on the bytes near by only, so an insertion moves the cuts next to it
and no others, and two texts with a common passage have the same cuts in it, but
for its ends. In a run of a few bytes repeated the least hash comes back again and
again: of such tied places one in ``RADIUS`` is cut, and chunks between them are
the same wherever the run is entered.

Chunks are known by 64 bits of a digest, one row per digest and task before they
are counted. A digest that occurs in several documents belongs to the smallest;
its occurrences in the others are seeds. A passage that two texts share shows
as a row of seeds without a gap: a chunk next to the row that is no seed bounds how
far the common bytes can reach. Rows that cannot reach ``min_words`` words are
dropped by that bound, without looking at any text. What is left is compared with
the owner's text: every window of ``min_words`` words within the bound whose bytes
stand there too, found by hash and confirmed byte by byte, is part of a passage.
So a passage counts from exactly ``min_words`` whole words, however they are cut.

Texts move once to be joined with what is asked of them; only the parts within
the bounds, and the texts of owners, move again. An owner that many ask is sent
once for each ``ASKS_AT_ONCE`` of them.

What can be missed: a passage so short in bytes that it holds no whole chunk, and
one whose every chunk belongs to still earlier documents that do not hold it.

Defined cases: null and empty texts have no chunks; a passage that a document
repeats within itself only is no repeat; equal rows are one document; rows without
doc_id, and rows that share a doc_id but not their text, are documents of their
own, one for each text, after all others (whose ids are below 2^62); no documents
give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverbrook.llm.common import stored

#: Bytes to either side among which a cut's hash is the least; chunks have some twice as many.
RADIUS = 13
#: Bytes that a hash depends on.
WINDOW = 8
#: From here on, numbers of texts stand for ids.
NO_ID = 2**62
#: Words from which on a common passage counts.
MIN_WORDS = 50
#: Parts of texts that are compared with one copy of their owner's text.
ASKS_AT_ONCE = 5_000
#: Bytes of text in a batch on its way out of a task.
BATCH_BYTES = 4 << 20

_CHUNKS = "key long, digest long, link int, low int, high int"
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
#: An odd number and its inverse modulo 2^64, and their powers, for hashes of windows of words.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes that are hashed at a time.
_BLOCK = 1 << 16
_BLOCK_POWER = pow(_BASE, _BLOCK, 2**64)
_BLOCK_INVERSE = pow(_INVERSE, _BLOCK, 2**64)
_POWERS, _INVERSES = (
    np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_BLOCK - 1, x, np.uint64)]), dtype=np.uint64)
    for x in (_BASE, _INVERSE)
)
_TABLE = np.random.default_rng(2).integers(0, 2**64, 256, dtype=np.uint64)


def gear_table(seed: int = 1) -> np.ndarray:
    """256 random 32-bit numbers, the same in every task."""
    return np.random.default_rng(seed).integers(0, 2**32, 256, dtype=np.uint32)


GEAR = gear_table()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte over the last ``WINDOW`` bytes, by doubling the span."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    return h


def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of a text's bytes, and whether each end is tied with a place near by."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    h = rolling_hash(data)
    least = np.full(n + 2 * RADIUS, 2**32 - 1, np.uint32)
    least[RADIUS : RADIUS + n] = h
    span = 1
    while span < RADIUS:
        step = min(span, RADIUS - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    least = np.minimum(least[:n], least[RADIUS + 1 : RADIUS + 1 + n])
    at = np.flatnonzero(h <= least)
    tied = h[at] == least[at]
    if tied.any():
        kept, last = [], -RADIUS - 1
        for i, place in enumerate(at.tolist()):
            if place - last > RADIUS:
                kept.append(i)
                last = place
        at, tied = at[kept], tied[kept]
    if not len(at) or at[-1] != n - 1:
        return np.append(at + 1, n), np.append(tied, False)
    tied[-1] = False
    return at + 1, tied


def _starts_of_words(data: np.ndarray) -> np.ndarray:
    space = _SPACES[data]
    begins = ~space
    begins[1:] &= space[:-1]
    return np.flatnonzero(begins)


def _chunks_of(key: int, raw: bytes) -> list[np.ndarray]:
    """The columns of a text's chunks.

    A chunk whose ends are both untied is firm: it is a chunk in every text that
    holds its surroundings. ``link`` counts firm chunks, so that seeds whose links
    differ by more than one have a firm chunk between them that is no seed; common
    bytes around seeds end within the firm chunks next to them, that is within
    the words from ``low`` to ``high``.
    """
    data = np.frombuffer(raw, np.uint8)
    ends, tied = cuts(data)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh3_64_intdigest
    bounds = zip(starts.tolist(), ends.tolist(), strict=True)
    digests = np.array([digest(raw[a:b]) for a, b in bounds], np.uint64).view(np.int64)
    firm = ~tied
    firm[1:] &= ~tied[:-1]
    firms = np.flatnonzero(firm)
    low = np.concatenate([[0], np.maximum(starts[firms] - RADIUS - WINDOW, 0)])
    high = np.concatenate([np.minimum(ends[firms] + RADIUS, len(data)), [len(data)]])
    link = np.cumsum(firm)
    words = _starts_of_words(data)
    return [
        np.full(len(ends), key, np.int64),
        digests,
        link.astype(np.int32),
        np.searchsorted(words, low[link - firm]).astype(np.int32),
        np.searchsorted(words, high[link]).astype(np.int32),
    ]


def _bytes(text: pa.Scalar) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in _CHUNKS.split(", ")]

    def batch_of(texts: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*texts, strict=True)], names)

    for batch in batches:
        held: list[list[np.ndarray]] = []
        rows = 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = _bytes(text)
            if not raw:
                continue
            held.append(_chunks_of(key, raw))
            rows += len(held[-1][0])
            if rows > 100_000:
                yield batch_of(held)
                held, rows = [], 0
        if held:
            yield batch_of(held)


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): the key is the doc_id or, where that does not tell texts apart, a number
    for id and text, behind all ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    number = F.pmod(F.xxhash64("text"), F.lit(NO_ID))
    texts = rows.select("doc_id", number.alias("n")).groupBy("doc_id").agg(F.min("n").alias("a"), F.max("n").alias("b"))
    shared = stored(texts.filter("a < b and doc_id is not null").select("doc_id", F.lit(True).alias("shared")), "shared-ids")
    own = F.lit(NO_ID) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(NO_ID))
    key: Column = F.when(F.col("doc_id").isNull() | F.col("shared"), own).otherwise(F.col("doc_id"))
    return rows.join(shared, "doc_id", "left").select(key.alias("key"), "doc_id", "text")


def chunk_table(keyed: DataFrame) -> DataFrame:
    """(key, digest, link, low, high) of every chunk of (key, text)."""
    return keyed.select("key", "text").mapInArrow(_chunked, _CHUNKS)


def _rows_of_seeds(min_words: int):
    """For each row of seeds that may hold a passage, and each owner in it: the words to be compared."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(1)
            seeds = parts.flatten()
            if not len(seeds):
                continue
            key = np.repeat(batch.column(0).to_numpy(), parts.value_lengths().to_numpy(zero_copy_only=False))
            link, low, high, owner = (seeds.field(i).to_numpy() for i in range(4))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (link[1:] - link[:-1] > 1)
            first = np.flatnonzero(new)
            low = np.minimum.reduceat(low, first)
            high = np.maximum.reduceat(high, first)
            row = np.cumsum(new) - 1
            wide = np.flatnonzero((high - low >= min_words)[row])
            asked = np.unique(np.stack([row[wide], owner[wide]]), axis=1)
            row, owner = asked[0], asked[1]
            columns = [key[first][row], low[row], high[row], owner]
            yield pa.record_batch([pa.array(c) for c in columns], ["key", "low", "high", "owner"])

    return rows


class _Words:
    """A text's words, and a hash of each window of so many: the difference of two running sums of its bytes."""

    def __init__(self, raw: bytes, width: int):
        self.raw = raw
        data = np.frombuffer(raw, np.uint8)
        self.starts = _starts_of_words(data)
        self.ends = len(data) - _starts_of_words(data[::-1])[::-1]
        self.width = width
        count = max(len(self.starts) - width + 1, 0)
        first, last = self.starts[:count], self.ends[width - 1 :]
        before, behind, back = (np.zeros(count, np.uint64) for _ in range(3))
        total, power, inverse = 0, 1, 1
        for at in range(0, len(data) + 1 if count else 0, _BLOCK):
            block = data[at : at + _BLOCK]
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(_TABLE[block] * _POWERS[: len(block)], out=sums[1:])
            for places, found in ((first, before), (last, behind)):
                a, b = np.searchsorted(places, (at, at + _BLOCK))
                found[a:b] = np.uint64(total) + sums[places[a:b] - at] * np.uint64(power)
            a, b = np.searchsorted(first, (at, at + _BLOCK))
            back[a:b] = _INVERSES[first[a:b] - at] * np.uint64(inverse)
            total = (total + int(sums[-1]) * power) % 2**64
            power = power * _BLOCK_POWER % 2**64
            inverse = inverse * _BLOCK_INVERSE % 2**64
        self.hashes = (behind - before) * back

    def bytes(self, first: int, last: int) -> bytes:
        """From the first window to the last."""
        return self.raw[self.starts[first] : self.ends[last + self.width - 1]]

    def sort(self) -> None:
        """Prepare to be searched."""
        self.order = np.argsort(self.hashes, kind="stable")
        self.sorted = self.hashes[self.order]
        self.listed = self.hashes.tolist()

    def common(self, part: _Words) -> Iterator[tuple[int, int]]:
        """First and last word of the runs of ``part`` that stand here, each of a window or more.

        A run goes on while its next window stands next here, too.
        """
        if not len(self.hashes):
            return
        found = np.minimum(np.searchsorted(self.sorted, part.hashes), len(self.sorted) - 1)
        hits = np.flatnonzero(self.sorted[found] == part.hashes)
        runs: list[list[int]] = []  # first window, last window, place of the last
        rows = zip(hits.tolist(), part.hashes[hits].tolist(), self.order[found[hits]].tolist(), strict=True)
        for i, value, place in rows:
            run = runs[-1] if runs else None
            if run and i == run[1] + 1 and run[2] + 1 < len(self.listed) and self.listed[run[2] + 1] == value:
                run[1], run[2] = i, run[2] + 1
            else:
                runs.append([i, i, place])
        for first, last, place in runs:
            if self.bytes(place - last + first, place) == part.bytes(first, last):
                yield first, last + self.width - 1
                continue
            for i in range(first, last + 1):  # some hash met by chance
                at = place - last + i
                if self.bytes(at, at) == part.bytes(i, i):
                    yield i, i + self.width - 1


_PARTS = "owner long, salt int, kind int, key long, doc_id long, start int, part binary"
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners' texts (kind 0), and the parts of other texts that are to be compared with them (kind 1)."""
    names = [x.split(" ")[0] for x in _PARTS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names)

    rows: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(n) for n in ("key", "doc_id", "text", "asks", "salts")]
        for key, doc_id, text, asks, salts in zip(*columns, strict=True):
            raw, key, doc_id = _bytes(text), key.as_py(), doc_id.as_py()
            asked = asks.as_py() or ()
            if asked:
                starts = _starts_of_words(np.frombuffer(raw, np.uint8))
            for ask in asked:
                begin = int(starts[ask["low"]])
                end = int(starts[ask["high"]]) if ask["high"] < len(starts) else len(raw)
                rows.append((ask["owner"], ask["salt"], 1, key, doc_id, begin, raw[begin:end]))
                size += end - begin
                if size > BATCH_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
            for salt in range(salts.as_py() or 0):
                rows.append((key, salt, 0, None, doc_id, 0, raw))
                size += len(raw)
                if size > BATCH_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
    if rows:
        yield batch_of(rows)


_FOUND = "doc_id long, start int, length int, words int, keep_id long, doc long"


def _compared(min_words: int):
    """Compare parts with the owner's text, which comes before them."""
    names = [x.split(" ")[0] for x in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = keep_id = text = None
        for batch in batches:
            rows = []
            heads = [batch.column(n).to_pylist() for n in ("owner", "kind", "key", "doc_id", "start")]
            for who, kind, key, doc_id, start, part in zip(*heads, batch.column("part"), strict=True):
                if kind == 0:
                    if who != owner:
                        owner, keep_id, text = who, doc_id, _Words(part.as_py(), min_words)
                        text.sort()
                    continue
                mine = _Words(part.as_py(), min_words)
                for first, last in text.common(mine):
                    begin, end = int(mine.starts[first]), int(mine.ends[last])
                    rows.append((doc_id, start + begin, end - begin, last - first + 1, keep_id, key))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return compare


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``min_words`` whole words or more that stand in an earlier document.

    Columns: doc_id, start and length (UTF-8 bytes), words, keep_id (the earlier
    document), doc (what rows without an id of their own are told apart by).
    A passage that lies within another of its document is not told.
    """
    keyed = _keyed(docs)
    chunks = chunk_table(keyed)
    owners = (
        chunks.select("key", "digest")
        .groupBy("digest")
        .agg(F.min("key").alias("owner"), F.max("key").alias("last"))
        .filter("owner < last")
        .select("digest", "owner")
    )
    # A document's own seeds are bounded by its chunks.
    seeds = F.array_sort(F.collect_set(F.struct("link", "low", "high", "owner"))).alias("seeds")
    found = chunks.join(owners, "digest").filter("key <> owner").groupBy("key").agg(seeds)
    asks = stored(found.mapInArrow(_rows_of_seeds(min_words), "key long, low int, high int, owner long"), "asks")
    asked = asks.groupBy("owner").agg(F.ceil(F.count("*") / ASKS_AT_ONCE).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("key", "low"), "salts").cast("int").alias("salt")
    of_key = asks.join(asked, "owner").groupBy("key").agg(
        F.collect_list(F.struct("low", "high", "owner", salt)).alias("asks")
    )
    wanted = of_key.join(asked.withColumnRenamed("owner", "key"), "key", "full")
    parts = keyed.join(wanted, "key").select("key", "doc_id", "text", "asks", "salts").mapInArrow(_parts, _PARTS)
    ordered = parts.repartition("owner", "salt").sortWithinPartitions("owner", "salt", "kind")
    passages = ordered.mapInArrow(_compared(min_words), _FOUND)
    end = F.col("start") + F.col("length")
    before = Window.partitionBy("doc").orderBy("start", F.desc("length"), "keep_id")
    reach = F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1))
    return passages.withColumn("reach", reach).filter(F.col("reach").isNull() | (F.col("reach") < end)).drop("reach")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            raw, at, kept = _bytes(text), 0, []
            for span in spans.as_py() or ():
                kept.append(raw[at : span["start"]])
                at = max(at, span["start"] + span["length"])
            texts.append((b"".join(kept) + raw[at:]).decode("utf-8", "surrogatepass"))
        yield pa.record_batch([batch.column("doc_id"), pa.array(texts, batch.column("text").type)], ["doc_id", "text"])


def without_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, text) of every row, without the bytes of its repeated passages."""
    spans = passages.groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans")
    )
    joined = _keyed(docs).withColumnRenamed("key", "doc").join(spans, "doc", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut_out, "doc_id long, text string")
