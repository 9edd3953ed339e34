"""Token ids in seekable files: independent zstandard frames and a trailing seek table.

A file holds the documents of one range of ids, in ascending order. Its frames
are independent, so a reader decompresses only those it needs:

    frame:       documents (count; then per document a flag, doc_id, length), then their ids
    index:       skippable frame: flag and doc_id of the first document of each frame
    seek table:  skippable frame in zstandard's seekable format: compressed size,
                 size and checksum (low half of XXH64) of each frame, then their
                 number, a descriptor and the closing magic number

Ids take two bytes each where the vocabulary fits, else four. The seek table's
last nine bytes tell where everything else is.

Writing range-partitions and sorts documents by id, encodes them where they
arrive, and writes one file per task under a name of its own before renaming
it, so a task that runs twice leaves one whole file. Memory holds one frame and
one chunk of texts. The number of ids before a file comes from one row per file.

Files are written to and read from the shared folder through pyarrow's
filesystems, so it may be a mounted path or a store that pyarrow knows.

Defined cases: a null text is the end id alone; rows without doc_id come first;
rows with equal ids follow each other in the order of a hash of their texts; no documents
give no files and no rows; other columns are ignored. A frame whose checksum
does not agree raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import stored
from silverbrook.llm.tokens import encoder

END_ID = 2
#: Uncompressed bytes at which a frame is closed.
FRAME_BYTES = 256 * 1024
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80  # descriptor: entries carry checksums
INDEX = 0x184D2A50  # another skippable frame, for the index

_DOC = struct.Struct("<BqQ")
_FIRST = struct.Struct("<Bq")
_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")
_SKIP = struct.Struct("<II")

_FILES = "path string, part long, documents long, tokens long, has_id boolean, first_id long"
_ROWS = "path string, doc_id long, tokens_before long, n_tokens long, ids_crc32 long"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        scheme, rest = path.split(":", 1)
        # file:/a, file:///a and file://a/b mean local paths here.
        if scheme == "file":
            return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Write documents into frames of an open file; ``close`` adds index and seek table."""

    def __init__(self, file, dtype: np.dtype) -> None:
        self.file = file
        self.dtype = dtype
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.entries: list[bytes] = []
        self.firsts: list[bytes] = []
        self.documents = self.tokens = 0
        self._clear()

    def _clear(self) -> None:
        self.heads: list[bytes] = []
        self.ids: list[bytes] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        known = doc_id is not None
        if not self.heads:
            self.firsts.append(_FIRST.pack(known, doc_id if known else 0))
        self.heads.append(_DOC.pack(known, doc_id if known else 0, len(ids)))
        self.ids.append(ids.astype(self.dtype, copy=False).tobytes())
        self.size += _DOC.size + len(self.ids[-1])
        self.documents += 1
        self.tokens += len(ids)
        if self.size >= FRAME_BYTES:
            self._close_frame()

    def first(self) -> tuple[bool, int]:
        """Whether the first document has an id, and the id."""
        known, doc = _FIRST.unpack(self.firsts[0])
        return bool(known), doc

    def _close_frame(self) -> None:
        if not self.heads:
            return
        head = struct.pack("<IB", len(self.heads), self.dtype.itemsize)
        data = head + b"".join(self.heads) + b"".join(self.ids)
        frame = self.compressor.compress(data)
        self.file.write(frame)
        self.entries.append(_ENTRY.pack(len(frame), len(data), _checksum(data)))
        self._clear()

    def close(self) -> None:
        self._close_frame()
        index = b"".join(self.firsts)
        self.file.write(_SKIP.pack(INDEX, len(index)) + index)
        table = b"".join(self.entries) + _FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.file.write(_SKIP.pack(SKIPPABLE, len(table)) + table)
        self.file.close()


@dataclass(frozen=True)
class _Frame:
    start: int
    packed: int
    size: int
    checksum: int
    first: tuple[bool, int]


class FrameReader:
    """Documents of one file; only the frames asked for are decompressed."""

    def __init__(self, path: str) -> None:
        system, at = _filesystem(path)
        self.file = system.open_input_file(at)
        size = self.file.size()
        count, flags, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table")
        table = count * _ENTRY.size
        at_table = size - _FOOTER.size - table
        entries = list(_ENTRY.iter_unpack(self.file.read_at(table, at_table))) if count else []
        at_index = sum(e[0] for e in entries) + _SKIP.size
        length = count * _FIRST.size
        firsts = list(_FIRST.iter_unpack(self.file.read_at(length, at_index))) if count else []
        self.frames, start = [], 0
        for (packed, plain, checksum), (known, doc) in zip(entries, firsts, strict=True):
            self.frames.append(_Frame(start, packed, plain, checksum, (bool(known), doc)))
            start += packed

    def close(self) -> None:
        self.file.close()

    def frame(self, number: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """The documents of one frame, with their ids."""
        f = self.frames[number]
        data = zstandard.ZstdDecompressor().decompress(
            self.file.read_at(f.packed, f.start), max_output_size=f.size
        )
        if len(data) != f.size or _checksum(data) != f.checksum:
            raise ValueError(f"frame {number}: wrong checksum")
        count, width = struct.unpack_from("<IB", data)
        at = 5 + count * _DOC.size
        for known, doc, length in _DOC.iter_unpack(data[5:at]):
            yield (doc if known else None), np.frombuffer(data, f"<u{width}", length, at)
            at += width * length

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for number in range(len(self.frames)):
            yield from self.frame(number)

    def find(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Only the documents with these ids, from only the frames that may hold them."""
        wanted = set(wanted)
        for number in sorted({n for doc in wanted for n in may_hold([f.first for f in self.frames], doc)}):
            for doc, ids in self.frame(number):
                if doc in wanted:
                    yield doc, ids


def may_hold(firsts: list[tuple[bool, int]], doc: int) -> range:
    """Which of sorted runs, known by their first documents, may hold an id; equal ids may cross runs."""
    key = (True, doc)
    return range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key))


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        encode = encoder(tokenizer)
        system, root = _filesystem(folder)
        name = f"{root}/part-{part:06d}.tokens"
        aside = f"{name}.{task.taskAttemptId()}"
        writer = None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            for doc, tokens in zip(ids, encode.encode(texts), strict=True):
                if writer is None:
                    system.create_dir(root, recursive=True)
                    dtype = encode.dtype if end_id < 2 ** (8 * encode.dtype.itemsize) else np.dtype("<u4")
                    writer = FrameWriter(system.open_output_stream(aside), dtype)
                writer.add(doc, np.append(tokens, np.array(end_id, writer.dtype)))
        if writer is not None:
            writer.close()
            system.move(aside, name)
            known, first = writer.first()
            row = {
                "path": f"{folder}/part-{part:06d}.tokens",
                "part": part,
                "documents": writer.documents,
                "tokens": writer.tokens,
                "has_id": known,
                "first_id": first,
            }
            yield pa.RecordBatch.from_pylist([row])

    return write


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all documents; one row per file, with its totals and its first doc_id."""
    rows = docs.select("doc_id", F.col("text").cast("string"), F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return stored(ordered.mapInArrow(_writer(folder, tokenizer, end_id), _FILES), "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            reader = FrameReader(path)
            before = 0
            for number in range(len(reader.frames)):
                rows = []
                for doc, ids in reader.frame(number):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((path, doc, before, len(ids), crc))
                    before += len(ids)
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch(
                    [pa.array(columns[0], pa.string())] + [pa.array(c, pa.int64()) for c in columns[1:]],
                    ["path", "doc_id", "tokens_before", "n_tokens", "ids_crc32"],
                )
            reader.close()


def read_digests(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = files.select(
        F.col("path").alias("file"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before")
    )
    spread = files.select("path").repartition(max(1, files.count()), "path")
    rows = spread.mapInArrow(_read, _ROWS)
    return rows.join(F.broadcast(starts), rows["path"] == starts["file"]).select(
        "doc_id", (F.col("before") + F.col("tokens_before")).alias("start"), "n_tokens", "ids_crc32"
    )


def find_documents(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the requested doc_ids; each file reads the frames of the ids that fall to it."""
    listed = files.orderBy("part").select("path", "has_id", "first_id").collect()  # a row per file
    paths = [r["path"] for r in listed]
    firsts = [(r["has_id"], r["first_id"]) for r in listed]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt = [(paths[n], d) for d in batch.column(0).to_pylist() for n in may_hold(firsts, d)]
            yield pa.record_batch(
                [pa.array([x[0] for x in dealt], pa.string()), pa.array([x[1] for x in dealt], pa.int64())],
                ["path", "doc_id"],
            )

    def look(key: tuple, group: pa.Table) -> pa.Table:
        reader = FrameReader(key[0].as_py())
        found = [(d, x.astype("<u4").tobytes()) for d, x in reader.find(group["doc_id"].to_pylist())]
        reader.close()
        return pa.table(
            {
                "doc_id": pa.array([d for d, _ in found], pa.int64()),
                "ids": pa.array([x for _, x in found], pa.binary()),
            }
        )

    asked = wanted.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct()
    asked = asked.mapInArrow(deal, "path string, doc_id long")
    return asked.groupBy("path").applyInArrow(look, "doc_id long, ids binary")
