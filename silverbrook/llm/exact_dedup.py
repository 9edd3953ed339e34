"""Exact dedup against a minimal perfect hash over historical digests.

Texts are equal when they agree after each run of white space became one space;
a text is known by the SHA-256 of that form. The history's distinct digests are
spread over buckets by their first bytes, and each bucket holds a minimal
perfect hash: levels of bit arrays, where a digest sits at the first level at
which no other digest of the bucket shares its bit, and the rank of that bit is
its slot. The slot stores the full digest and where the surviving row is. A new
digest is looked up in its bucket and compared byte for byte with the slot's
digest: equal means a repeat of history; everything else forms its own groups.

Digests are reduced to one row each before any of this, so a text that holds a
third of all rows costs one lookup. Buckets hold distinct digests and are of
even size; their number follows the larger of both counts.

Defined cases: a null text counts as empty; rows without doc_id come after all
others; of rows that repeat both doc_id and text exactly one is kept; an empty
history or an empty batch is fine; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import SPACE, first_of_equal, fresh, stored, text_or_empty

#: Digests per bucket: about 5 MB of slots.
BUCKET_DIGESTS = 100_000
#: Bits per digest still unplaced at a level.
GAMMA = 2.0

_INDEX = "bucket long, n long, levels binary, digests binary, locators binary, counts binary"
_FOUND = "digest binary, keep_id long, copies long, in_history boolean"


def normalised(column: str = "text"):
    return F.regexp_replace(text_or_empty(column), f"{SPACE}+", " ")


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest and copies: one row per different pair, with its count."""
    digest = F.unhex(F.sha2(normalised(), 256))
    return docs.select("doc_id", digest.alias("digest")).groupBy("digest", "doc_id").agg(
        F.count("*").alias("copies")
    )


def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(digests).view("<u8")
    return words[:, 2], words[:, 3]


def _bits(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest at a level: digests are uniform, levels remix two of their words."""
    with np.errstate(over="ignore"):
        x = a ^ (b * np.uint64(2 * level + 1)) ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits over n distinct 32-byte digests, and the slot (0 to n-1) of each digest."""
    n = len(digests)
    a, b = _words(digests)
    levels: list[np.ndarray] = []
    left, placed = np.arange(n), np.zeros(n, np.int64)
    before = 0
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        at = _bits(a[left], b[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        settled = alone[at]
        placed[left[settled]] = before + (np.cumsum(alone) - 1)[at[settled]]
        before += int(alone.sum())
        left = left[~settled]
    return levels, placed


def find_slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The slot each digest would have; any slot, or -1, for one that is not a member."""
    a, b = _words(digests)
    slots = np.full(len(digests), -1, np.int64)
    left, before = np.arange(len(digests)), 0
    for level, alone in enumerate(levels):
        at = _bits(a[left], b[left], level, len(alone))
        hit = alone[at]
        slots[left[hit]] = before + (np.cumsum(alone) - 1)[at[hit]]
        before += int(alone.sum())
        left = left[~hit]
    return slots


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _pack(levels: list[np.ndarray]) -> bytes:
    head = np.array([len(levels), *map(len, levels)], "<i8").tobytes()
    return head + b"".join(np.packbits(x).tobytes() for x in levels)


def _unpack(data: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", count, 8)
    levels, at = [], 8 * (count + 1)
    for size in map(int, sizes):
        raw = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
        levels.append(np.unpackbits(raw, count=size).astype(bool))
        at += len(raw)
    return levels


def _locators(ids: pa.ChunkedArray) -> np.ndarray:
    """Row ids with a flag beside them, so that a missing id stays one."""
    known = np.array(ids.is_valid().to_pylist(), bool)
    return np.stack([known.astype("<i8"), np.array(ids.fill_null(0).to_pylist(), "<i8")], axis=1)


def _build_bucket(key: tuple, group: pa.Table) -> pa.Table:
    digests = _matrix(group["digest"])
    levels, slots = build_hash(digests)
    order = np.empty_like(slots)
    order[slots] = np.arange(len(slots))
    locators = _locators(group["keep_id"])[order]
    counts = np.array(group["copies"].to_pylist(), "<i8")[order]
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()], pa.int64()),
            "n": pa.array([len(slots)], pa.int64()),
            "levels": pa.array([_pack(levels)], pa.binary()),
            "digests": pa.array([digests[order].tobytes()], pa.binary()),
            "locators": pa.array([locators.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
        }
    )


def _found(digests: list[bytes], ids: list, copies: list[int], member: list[bool]) -> pa.Table:
    return pa.table(
        {
            "digest": pa.array(digests, pa.binary()),
            "keep_id": pa.array(ids, pa.int64()),
            "copies": pa.array(copies, pa.int64()),
            "in_history": pa.array(member, pa.bool_()),
        }
    )


def _look_up(probe: pa.Table, index: pa.Table) -> pa.Table:
    """Every digest of a bucket with its survivor: history's rows, then the new ones not in it."""
    new = probe["digest"].to_pylist()
    ids, copies = probe["keep_id"].to_pylist(), probe["copies"].to_pylist()
    if not index.num_rows:
        return _found(new, ids, copies, [False] * len(new))
    row = index.to_pylist()[0]
    n = row["n"]
    stored_digests = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
    locators = np.frombuffer(row["locators"], "<i8").reshape(n, 2)
    totals = np.frombuffer(row["counts"], "<i8").copy()
    member = np.zeros(len(new), bool)
    if new:
        mine = _matrix(probe["digest"])
        slots = find_slots(_unpack(row["levels"]), mine)
        # The byte check: a digest that is not a member also gets some slot.
        member = (slots >= 0) & (stored_digests[slots] == mine).all(axis=1)
        np.add.at(totals, slots[member], np.array(copies, np.int64)[member])
    fresh = [i for i, known in enumerate(member) if not known]
    return _found(
        [stored_digests[i].tobytes() for i in range(n)] + [new[i] for i in fresh],
        [int(v) if known else None for known, v in locators] + [ids[i] for i in fresh],
        totals.tolist() + [copies[i] for i in fresh],
        [True] * n + [False] * len(fresh),
    )


def group_digests(pairs: DataFrame) -> DataFrame:
    """Per digest: the smallest doc_id (null when none has one) and the number of rows."""
    return pairs.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("copies")
    )


def _bucket(buckets: int):
    # The first eight bytes choose the bucket; the hash inside uses later ones.
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets))


def build_index(groups: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: the hash's levels, and per slot digest, survivor and count."""
    return groups.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInArrow(
        _build_bucket, _INDEX
    )


def survivors(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Per digest of either side its survivor: history's row wins, else the batch's smallest id.

    Both sides are (digest, doc_id, copies). Columns: digest, keep_id, copies
    (rows on both sides), in_history.
    """
    old, new = stored(group_digests(history), "digests"), stored(group_digests(batch), "digests")
    buckets = max(1, -(-max(old.count(), new.count()) // BUCKET_DIGESTS))
    # More buckets than the size asks for, so that every core has some.
    buckets = max(buckets, int(history.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = stored(build_index(old, buckets), "digest-index")
    probe = new.withColumn("bucket", _bucket(buckets))
    return (
        probe.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInArrow(_look_up, _FOUND)
    )


def mark_repeats(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per document with its survivor; joined on the digest, whose hot values can be split."""
    found = found.select("digest", "keep_id", F.col("copies").alias("group_size"), "in_history")
    nth = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return (
        pairs.join(found, "digest")
        .select("*", nth.alias("nth"))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "in_history",
        )
    )


def _pairs_and_survivors(docs: DataFrame, history_share: float) -> tuple[DataFrame, DataFrame]:
    pairs = stored(text_digests(docs), "text-digests")
    split = pairs.select(F.percentile_approx("doc_id", history_share, 1000)).first()[0]
    old = F.col("doc_id") <= F.lit(split) if split is not None else F.lit(False)
    old = F.coalesce(old, F.lit(False))
    return pairs, survivors(pairs.filter(old), pairs.filter(~old))


def exact_dedup(docs: DataFrame, history_share: float = 0.5) -> DataFrame:
    """Every document with the row that stays for its text.

    The documents with the lowest ids (a share of about ``history_share``) are
    the history, the rest the new batch, so the smallest id of equal texts
    stays. Columns: doc_id, keep_id, group_size, kept, text_sha256, in_history.
    """
    return mark_repeats(*_pairs_and_survivors(docs, history_share))


def drop_repeats(docs: DataFrame, history_share: float = 0.5) -> DataFrame:
    """The rows that stay, with all their columns: one for each different text."""
    _, found = _pairs_and_survivors(docs, history_share)
    digest, keep = fresh(docs, "text_digest"), fresh(docs, "keep_digest")
    stays = found.select(F.col("digest").alias(keep), F.col("keep_id"))
    named = docs.withColumn(digest, F.unhex(F.sha2(normalised(), 256)))
    # Rows that repeat both the text and the id are one row first.
    once = first_of_equal(named, digest, "doc_id")
    same = (once[digest] == stays[keep]) & once["doc_id"].eqNullSafe(stays["keep_id"])
    return once.join(stays, same, "left_semi").drop(digest)
