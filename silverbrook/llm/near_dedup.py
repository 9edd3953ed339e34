"""Near-duplicate groups by one-permutation MinHash, banded buckets and star-shaped candidates.

A text's words are its runs of characters other than ASCII white space, A-Z
lower-cased; its set holds the 64-bit hashes of its five-word shingles (two
shingles of a pair agree by chance about once in 2^64). Texts with equal sets
are one node from the start, whatever their number.

One hash per shingle gives the whole signature: the hash range is cut into
``BANDS * ROWS`` bins and each bin keeps its smallest hash. An empty bin
borrows from a bin chosen by a hash of its own number and the attempt, until
one is not empty (optimal densification). Bands of ``ROWS`` slots are bucket
keys: a pair at the threshold of 0.85 meets in none of 32 bands of 6 with a
chance of 3 in 10 million, and a closer pair less. The pipeline's stage takes
pairs from 0.80 on as near copies; there 32 bands of 6 would miss 6 in 100,000,
so it uses 40 bands of 5, which miss 1 in 8 million.

A bucket links all its nodes to one centre: as many candidates as members, not
all pairs. Candidates are confirmed on the full sets. A link between two
members of a bucket that the centre does not reach is not lost: where the
members of a bucket then still lie in several components, those outside its
largest one are compared with all its members. They are dealt in blocks of a
bounded size, so a crowded bucket is many small groups; a block estimates
similarities from signatures, confirms what comes within six deviations of the
threshold on the full sets, and returns links only. A pair is looked at in the
first band it shares.

Rows move by bucket key and node with counts first, hot buckets stay on the
side of a join that adaptive execution can split, and sets are computed again
for nodes that share a bucket, once, since all sets together are larger than
the texts.

Defined cases: a text that is null, empty or white space has an empty set and
is linked with nothing; a text of fewer words has one shingle, the whole
sequence; rows that repeat a doc_id are rows of one document; a missing doc_id
is larger than any other; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import digest16, fresh, give_back, stored
from silverbrook.llm.components import components

SHINGLE_WORDS = 5
BANDS = 32
ROWS = 6
#: Linked when 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
#: Threshold of the pipeline's stage, and bands for it.
STAGE_THRESHOLD = 80
STAGE_BANDS = 40
STAGE_ROWS = 5
#: Bytes of sets in a block of a bucket.
BLOCK_BYTES = 4_000_000
#: Deviations of an estimated similarity below the threshold that are still confirmed.
DEVIATIONS = 6
#: Characters of text shingled at a time.
CHUNK_CHARS = 2_000_000

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_NODES = "doc_id long, n_shingles long, node binary, bands array<long>"
_SETS = "node binary, shingles binary"


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shingle_chunk(texts: list[str], words_each: int) -> list[np.ndarray]:
    # bytes.split() cuts at ASCII white space only, bytes.lower() touches A-Z only.
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = [w for own in words for w in own]
    if not flat:
        return [np.empty(0, np.uint64)] * len(texts)
    codes, distinct = pd.factorize(np.array(flat, dtype=object))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))[codes]
    with np.errstate(over="ignore"):
        last = max(0, len(hashes) - words_each + 1)
        joined = np.full(last, np.uint64(words_each))
        for i in range(words_each):
            joined = joined * _PRIME + hashes[i : i + last]
        joined = _mix(joined)
        sets, at = [], 0
        for own in words:
            n = len(own)
            if n >= words_each:
                sets.append(np.unique(joined[at : at + n - words_each + 1]))
            elif n:
                whole = np.uint64(n)
                for h in hashes[at : at + n]:
                    whole = whole * _PRIME + h
                sets.append(_mix(np.array([whole], np.uint64)))
            else:
                sets.append(np.empty(0, np.uint64))
            at += n
    return sets


def shingle_sets(texts: Iterator[str], words_each: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    chunk: list[str] = []
    size = 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield from _shingle_chunk(chunk, words_each)
            chunk, size = [], 0
    yield from _shingle_chunk(chunk, words_each)


@functools.cache
def _donors(slots: int, attempt: int) -> np.ndarray:
    """The bin that each bin asks at an attempt."""
    with np.errstate(over="ignore"):
        x = np.arange(slots, dtype=np.uint64) * _PRIME + np.uint64(attempt * 0xD1B54A32D192ED03 % 2**64)
    return (_mix(x) % np.uint64(slots)).astype(np.int64)


def signature(shingles: np.ndarray, slots: int) -> np.ndarray:
    """One-permutation MinHash of a sorted, non-empty set: bins of the hash range, empty ones densified."""
    edges = np.arange(slots, dtype=np.uint64) * np.uint64(2**64 // slots)
    first = np.searchsorted(shingles, edges)
    filled = np.diff(np.append(first, len(shingles))) > 0
    # The last bin also takes what is left over when 2^64 is not a multiple of the slots.
    slots_of = shingles[np.minimum(first, len(shingles) - 1)]
    if filled.sum() == 1:
        return np.full(slots, slots_of[filled][0])
    empty, attempt = np.flatnonzero(~filled), 0
    while len(empty):
        donors = _donors(slots, attempt)[empty]
        good = filled[donors]
        slots_of[empty[good]] = slots_of[donors[good]]
        empty, attempt = empty[~good], attempt + 1
    return slots_of


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    slots = signature(shingles, bands * rows).reshape(bands, rows)
    with np.errstate(over="ignore"):
        keys = np.arange(1, bands + 1, dtype=np.uint64)
        for i in range(rows):
            keys = _mix(keys * _PRIME + slots[:, i])
    return keys.view(np.int64)


def _describe(words_each: int, bands: int, rows: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, keys = [], [], []
            for s in shingle_sets((t.as_py() or "" for t in batch.column(1)), words_each):
                counts.append(len(s))
                nodes.append(digest16(s.tobytes()) if len(s) else None)
                keys.append(band_keys(s, bands, rows) if len(s) else None)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "node", "bands"],
            )
        give_back()

    return describe


def _shingled(words_each: int):
    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets, size = [], [], 0
            for s in shingle_sets((t.as_py() or "" for t in batch.column(0)), words_each):
                nodes.append(digest16(s.tobytes()))
                sets.append(s.tobytes())
                size += s.nbytes
                if size > 16_000_000:
                    yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"])
                    nodes, sets, size = [], [], 0
            yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"])
        give_back()

    return shingled


def _linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets reach the threshold, by their whole contents."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _confirm(threshold: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("left_set"), batch.column("right_set"), strict=True)
            good = [
                _linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), threshold)
                for x, y in pairs
            ]
            kept = pa.array(good, pa.bool_())
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(kept)
        give_back()

    return confirm


def _close_in_size(threshold: int):
    """Whether the sizes of a pair's sets allow the threshold at all."""
    return 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")


def _shingle_table(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words_each: int) -> DataFrame:
    """(node, shingles) of the given nodes, from a document of each."""
    source = classes.join(nodes, "node", "left_semi").select(F.col("doc_id").alias("source")).distinct()
    texts = docs.select("doc_id", F.col("text").cast("string"))
    texts = texts.join(source, F.col("doc_id").eqNullSafe(F.col("source")), "left_semi").select("text")
    sets = texts.mapInArrow(_shingled(words_each), _SETS)
    # Rows that repeat a doc_id may bring other nodes, or one node more than once.
    return sets.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right_set"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left_set", "right_set")
    return both.mapInArrow(_confirm(threshold), "a binary, b binary")


def _compared(bands: int, rows: int, threshold: int):
    """Links between the queries and the members of one block of a bucket."""

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        asks = np.array(group["asks"].to_pylist(), bool)
        labels, nodes = group["label"].to_pylist(), group["node"].to_pylist()
        codes = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)[1]
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        band = group["band"][0].as_py()
        signs = np.stack([signature(x, bands * rows) for x in sets])
        members = np.flatnonzero(~asks)
        t = threshold / 100
        found: list[tuple[bytes, bytes]] = []
        for i in np.flatnonzero(asks):
            small, large = np.minimum(sizes[members], sizes[i]), np.maximum(sizes[members], sizes[i])
            same = signs[members] == signs[i]
            spread = np.sqrt(t * (1 - t) / np.minimum(small, bands * rows))
            near = (
                (codes[members] != codes[i])
                & (100 * small >= threshold * large)
                & (same.mean(axis=1) >= t - DEVIATIONS * spread)
            )
            for at in np.flatnonzero(near):
                whole = same[at].reshape(bands, rows).all(axis=1)
                if whole.argmax() == band and _linked(sets[i], sets[members[at]], threshold):
                    found.append((nodes[i], nodes[members[at]]))
        return pa.table(
            {
                "a": pa.array([x for x, _ in found], pa.binary()),
                "b": pa.array([x for _, x in found], pa.binary()),
            }
        )

    return compare


def _links_across(members: DataFrame, labels: DataFrame, sets: DataFrame, bands: int, rows: int, threshold: int) -> DataFrame:
    """Links that the centres did not reach: within buckets whose members lie in several components."""
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = labelled.groupBy("bucket", "label").agg(F.count("*").alias("size"), F.sum("n").alias("hashes"))
    buckets = sizes.groupBy("bucket").agg(
        F.count("*").alias("labels"),
        F.max_by("label", F.struct("size", "label")).alias("main"),
        F.sum("hashes").alias("hashes"),
        (F.sum("hashes") - F.max_by("hashes", F.struct("size", "label"))).alias("asking"),
    )

    def blocks(hashes: str):
        return F.ceil(F.col(hashes) * 8 / BLOCK_BYTES).cast("int")

    buckets = buckets.filter("labels > 1").select(
        "bucket", "main", blocks("hashes").alias("blocks"), blocks("asking").alias("ask_blocks")
    )
    rows_open = stored(labelled.join(buckets, "bucket"), "open-buckets").join(sets, "node")
    own = F.pmod(F.xxhash64("node"), F.lit(2**31)).cast("int")
    columns = ["bucket", "band", "node", "label", "shingles"]
    # Every member meets every block of queries, every query every block of members.
    as_member = rows_open.select(
        *columns,
        F.lit(False).alias("asks"),
        (own % F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1)).alias("ask_block"),
    )
    as_query = rows_open.filter("label <> main").select(
        *columns,
        F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        (own % F.col("ask_blocks")).alias("ask_block"),
    )
    dealt = as_member.unionByName(as_query)
    compare = _compared(bands, rows, threshold)
    return dealt.groupBy("bucket", "ask_block", "block").applyInArrow(compare, "a binary, b binary")


def near_groups(
    docs: DataFrame,
    words_each: int = SHINGLE_WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept of every row."""
    described = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _describe(words_each, bands, rows), _NODES
    )
    described = stored(described, "signatures")
    classes = described.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    classes = stored(classes, "classes")
    every = classes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("centre"))
    shared = shared.filter("size > 1").select("bucket", "centre")
    members = stored(every.join(shared, "bucket"), "buckets")
    nodes = members.select("node").distinct()
    sets = stored(_shingle_table(docs, classes, nodes, words_each), "sets")

    pairs = members.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"), F.col("n").alias("n_b"))
    pairs = pairs.distinct().join(classes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
    links = stored(_confirmed(pairs.filter(_close_in_size(threshold)), sets, threshold), "links")
    labels = stored(components(links), "labels")
    across = stored(_links_across(members, labels, sets, bands, rows, threshold), "links-across")
    if not across.isEmpty():
        stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = stored(components(stars.unionByName(across)), "labels")

    found = described.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "node").alias("label")
    )
    linked = found.filter("label IS NOT NULL")
    least = linked.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = found.filter("label IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = linked.join(least, "label").select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_repeats(
    docs: DataFrame, bands: int = STAGE_BANDS, rows: int = STAGE_ROWS, threshold: int = STAGE_THRESHOLD
) -> DataFrame:
    """The rows that stay, with all their columns: those of each group's smallest doc_id."""
    keep = fresh(docs, "keep_id")
    groups = near_groups(docs, bands=bands, rows=rows, threshold=threshold)
    stays = groups.filter("kept").select(F.col("doc_id").alias(keep)).distinct()
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays[keep]), "left_semi")
