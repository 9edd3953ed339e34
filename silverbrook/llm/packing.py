"""Best-fit-decreasing packing of documents into windows of a fixed length.

A document's ids (with an end id) are cut into full windows while they are
longer than one; what is left over is packed. Each task sorts the remainders by
falling length and puts each into the open window with the least room that
still holds it; a segment tree over remaining capacities finds that window in
log(window) steps. Nothing is shuffled: a task packs what it reads, holds
lengths and checksums, and ids only where they are asked for. It packs what it
holds after ``PACK_PIECES`` remainders or ``PACK_BYTES`` of their ids, alike
whether or not it holds the ids themselves, and hands pieces on in batches of
``BATCH_BYTES`` of ids, so memory is bounded and at most the last windows of each
packing are partly empty.

Defined cases: a null or empty text is its end id alone; a window-long document
is one full window; repeated rows are packed like any others; no documents give
no pieces; other columns are ignored. A sequence id is the task's number and a
count within the task: unique, not consecutive, and the same when a lost task
runs again over the same input split.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import give_back
from silverbrook.llm.tokens import UNITS, encoder

WINDOW = 1024
END_ID = 0
#: Remainders sorted and packed at a time, and bytes of their ids.
PACK_PIECES = 200_000
PACK_BYTES = 32_000_000
#: Pieces handed on at a time, and bytes of their ids.
BATCH_PIECES = 50_000
BATCH_BYTES = 4_000_000
#: Bits of a sequence id below the task's number.
TASK_BITS = 40

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class OpenWindows:
    """Windows by remaining capacity, with a segment tree that tells which capacities exist."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, capacity: int, change: int) -> None:
        node = self.leaves + capacity
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, sequence: int, capacity: int) -> None:
        if capacity:
            self.stacks[capacity].append(sequence)
            self._count(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The tightest window with room for ``length``, and its capacity; it is taken out."""
        node = self.leaves + length
        if not self.tree[node]:
            # Up to the first ancestor with something to its right, then down its left edge.
            while node > 1 and not (node % 2 == 0 and self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._count(capacity, -1)
        return self.stacks[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """The window (from 0) and the offset there of each piece."""
    open_windows = OpenWindows(window)
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    opened = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_windows.take(lengths[i])
        if found is None:
            found = opened, window
            opened += 1
        sequence, capacity = found
        placed[i] = sequence, window - capacity
        open_windows.put(sequence, capacity - lengths[i])
    return placed


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * (7 + with_ids)
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
    names = [x.split(" ")[0] for x in _PIECES.split(", ")]
    if with_ids:
        arrays.append(pa.array(columns[7], pa.binary()))
        names.append("ids")
    return pa.record_batch(arrays, names)


def _packer(path: str, window: int, end_id: int, with_ids: bool, units: int = UNITS):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, units).encode
        base = TaskContext.get().partitionId() << TASK_BITS
        sequences = 0
        whole: list[tuple] = []
        rest: list[tuple] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal sequences, held
            places = best_fit_decreasing([r[2] for r in rest], window)
            out: list[tuple] = []
            size = 0
            for i, (s, offset) in enumerate(places):
                r, rest[i] = rest[i], ()
                out.append((*r[:5], base + sequences + s, offset, *r[5:]))
                size += 4 * r[2]
                if len(out) >= BATCH_PIECES or with_ids and size >= BATCH_BYTES:
                    yield _batch(out, with_ids)
                    out, size = [], 0
            if out:
                yield _batch(out, with_ids)
            sequences += 1 + max((s for s, _ in places), default=-1)
            rest.clear()
            held = 0

        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            for doc, tokens in zip(ids, encode(texts), strict=True):
                tokens = np.append(tokens.astype("<u4"), np.uint32(end_id))
                for start in range(0, len(tokens), window):
                    piece = tokens[start : start + window].tobytes()
                    row = (doc, start, len(piece) // 4, zlib.crc32(piece), len(tokens))
                    extra = (piece,) if with_ids else ()
                    if len(piece) == 4 * window:
                        whole.append((*row, base + sequences, 0, *extra))
                        sequences += 1
                    else:
                        rest.append((*row, *extra))
                        held += len(piece)
                    if len(whole) >= BATCH_PIECES or with_ids and 4 * window * len(whole) >= BATCH_BYTES:
                        yield _batch(whole, with_ids)
                        whole = []
                if len(rest) >= PACK_PIECES or held >= PACK_BYTES:
                    yield from packed()
        if whole:
            yield _batch(whole, with_ids)
        yield from packed()
        give_back()

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
    units: int = UNITS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit integers.
    ``units`` bounds the memory of an encoder, not its results.
    """
    schema = _PIECES + (", ids binary" if with_ids else "")
    rows = docs.select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(_packer(tokenizer, window, end_id, with_ids, units), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences of pieces that carry their ids: sequence_id, length, ids.

    A sequence's pieces are at most a window of ids, so a group is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("ordered", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"]))
    return (
        pieces.groupBy("sequence_id")
        .agg(ordered.alias("ordered"), F.sum("length").alias("length"))
        .select("sequence_id", "length", joined.alias("ids"))
    )
