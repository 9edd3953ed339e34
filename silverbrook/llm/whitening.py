"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The wanted components are the leading eigenvectors of the vectors' covariance V,
which is never formed: a block of directions Q, the wanted ones and some guards,
is multiplied by V in one distributed pass over the centred vectors X,
V Q = X' (X Q) / n. Each task hands on one matrix as large as Q.

A round takes QR and Rayleigh-Ritz of the block, and then filters it: the
Chebyshev recurrence of a polynomial that is small on [0, a] and grows steeply
above, one pass a degree. V has no eigenvalue under 0, and a is the block's
smallest Ritz value, so the unwanted part of the spectrum is damped. Rounds go on
until the block is certified: every wanted pair has a residual |V u - e u| under
``TOLERANCE`` of the largest eigenvalue or, where rounding allows no less, under
``ROUGH`` and no smaller than in the round before. A block that needs too many
rounds is widened; one as wide as the vectors is exact after one pass, whatever
the spectrum.

All counts are exact: an entry c becomes the whole number floor(64 c) + 1,000,000,
sums are taken in decimals, and the vectors are stored once, as blocks of small
integers around a whole number near their mean, with which every pass works.
A task holds one block of at most ``BLOCK_ROWS`` vectors and ``BLOCK_BYTES`` at a
time. The tasks' matrices are added up in two steps beyond ``FAN`` tasks, so the
driver gets few of them.

Defined cases: vectors that are null or hold an entry that is null, not finite or
beyond ``LARGEST`` (no long holds it) are dropped; a vector shorter than the
longest counts as followed by zeros, an empty one as all zeros; missing and
repeated ids, and equal vectors, are kept like any others; a direction without
variance, as all are where all vectors are equal, has ``whitened`` null and 0 of
the variance, and stays out of ``identity_error`` (null when no other is left);
no vectors give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import stored

# How an entry becomes a whole number.
SCALE, OFFSET = 64, 1_000_000
#: Entries of this size and beyond have no such number in a long.
LARGEST = 2.0**56

COMPONENTS = 32
#: Directions besides the wanted ones; they speed the rounds up and are not returned.
GUARDS = 16
#: Residuals, as a share of the largest eigenvalue: certified, and taken when rounding allows no less.
TOLERANCE = 1e-14
ROUGH = 1e-11
#: A share of the largest eigenvalue that counts as no variance.
NOTHING = 1e-12
#: Largest degree of the filter, and how much it may enlarge one direction over another.
DEGREE = 12
GAIN = 1e8
#: Rounds after which the block is widened.
ROUNDS = 40
#: Bounds of a block of vectors, and of the rows that are handed on at a time.
BLOCK_ROWS = 8192
BLOCK_BYTES = 8_000_000
ROWS_AT_ONCE = 50_000
#: Tasks whose matrices go to the driver as they are.
FAN = 64

_KINDS = (("i1", 2**7 - 1), ("<i2", 2**15 - 1), ("<i4", 2**31 - 1), ("<i8", 2**63))
_BLOCK = "ids array<long>, kind string, data binary"
_OUT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def _whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length, x - OFFSET of all entries, one after the other) of the vectors that are kept."""
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.drop_null()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number
    with np.errstate(invalid="ignore"):
        wrong = ~(np.abs(entries) < LARGEST)
    bad = np.zeros(len(rows), bool)
    owner = np.repeat(np.arange(len(rows)), lengths)
    bad[owner[wrong]] = True
    kept = ~bad[owner]
    return rows[~bad], lengths[~bad], np.floor(SCALE * entries[kept]).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many vectors a task has (place -1), how many reach each place, and the sums there."""
    rows, counts, sums = 0, np.zeros(0, np.int64), []
    for batch in batches:
        kept, lengths, x = _whole_numbers(batch.column(0))
        rows += len(kept)
        longest = int(lengths.max(initial=0))
        if longest > len(counts):
            sums += [0] * (longest - len(counts))
            counts = np.concatenate([counts, np.zeros(longest - len(counts), np.int64)])
        place = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        counts[:longest] += np.bincount(place, minlength=longest)
        # Halves of 32 bits, which a batch cannot add up beyond a long.
        for part, shift in ((x >> 32, 32), (x & 0xFFFFFFFF, 0)):
            total = np.zeros(longest, np.int64)
            np.add.at(total, place, part)
            for i, value in enumerate(total.tolist()):
                sums[i] += value << shift
    columns = [
        pa.array([-1, *range(len(sums))], pa.int32()),
        pa.array([rows, *counts.tolist()], pa.int64()),
        pa.array([Decimal(0), *map(Decimal, sums)], pa.decimal128(38, 0)),
    ]
    yield pa.record_batch(columns, ["place", "vectors", "total"])


@dataclass(frozen=True)
class Fit:
    """Number of vectors, and per place the whole number near the mean and what the sum has beyond n times it."""

    n: int
    near: np.ndarray
    over: np.ndarray

    @property
    def places(self) -> int:
        return len(self.near)


def fit(vectors: DataFrame) -> Fit:
    """Exact counts and sums of the kept vectors, as x - OFFSET."""
    totals = vectors.mapInArrow(_summed, "place int, vectors long, total decimal(38,0)")
    totals = totals.groupBy("place").agg(F.sum("vectors").alias("vectors"), F.sum("total").alias("total"))
    found = sorted(totals.collect())  # a row per place
    n = found[0]["vectors"] if found else 0
    sums = [int(r["total"]) for r in found[1:]]
    near = [round_half(s, n) for s in sums]
    over = [s - n * m for s, m in zip(sums, near, strict=True)]
    return Fit(n, np.array(near, np.int64), np.array(over, np.int64))


def round_half(total: int, n: int) -> int:
    """The whole number nearest to total / n."""
    return (2 * total + n) // (2 * n) if n else 0


def _blocks(of: Fit):
    """The kept vectors less ``near``, in blocks of the smallest integers that hold them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, of.places))))
        for batch in batches:
            rows, lengths, x = _whole_numbers(batch.column(1))
            ids = batch.column(0).take(pa.array(rows))
            ends = np.cumsum(lengths)
            for at in range(0, len(rows), step):
                own = lengths[at : at + step]
                first = ends[at] - lengths[at]
                there = np.arange(of.places) < own[:, None]
                table = np.zeros(there.shape, np.int64)
                table[there] = x[first : first + own.sum()]
                table -= of.near
                size = max(-int(table.min(initial=0)), int(table.max(initial=0)))
                kind = next(k for k, most in _KINDS if size <= most)
                columns = [
                    pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), ids.slice(at, len(own))),
                    pa.array([kind]),
                    pa.array([table.astype(kind).tobytes()], pa.binary()),
                ]
                yield pa.record_batch(columns, ["ids", "kind", "data"])

    return build


def _tables(batches: Iterator[pa.RecordBatch], of: Fit) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    """The ids and whole numbers of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(2)[i].as_buffer(), batch.column(1)[i].as_py())
            yield batch.column(0)[i], data.reshape(-1, of.places)


def total(
    blocks: DataFrame, tasks: int, of: Fit, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]
) -> np.ndarray:
    """The sum over all blocks, read by so many tasks, of a matrix made from each block's centred vectors."""
    mean = of.over / of.n

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape)
        for _, table in _tables(batches, of):
            found += part(table.astype(np.float64) - mean)
        yield pa.record_batch([pa.array([found.tobytes()], pa.binary())], ["found"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape)
        for batch in batches:
            for own in batch.column(0):
                found += np.frombuffer(own.as_buffer()).reshape(shape)
        yield pa.record_batch([pa.array([found.tobytes()], pa.binary())], ["found"])

    parts = blocks.mapInArrow(sums, "found binary")
    if tasks > FAN:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(added, "found binary")
    found = np.zeros(shape)
    for row in parts.collect():
        found += np.frombuffer(row["found"]).reshape(shape)
    return found


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns by falling eigenvalue, the eigenvalues, and how they were found."""

    vectors: np.ndarray
    values: np.ndarray
    residual: float
    passes: int


def leading(
    multiply: Callable[[np.ndarray], np.ndarray], places: int, wanted: int, guards: int = GUARDS
) -> Components:
    """The leading eigenpairs of the positive semidefinite matrix that ``multiply`` applies to a block."""
    wanted = min(wanted, places)
    width = min(places, wanted + guards)
    rng = np.random.default_rng(11)
    passes = 0
    block = np.linalg.qr(rng.standard_normal((places, width)))[0]
    before = math.inf
    rounds = 0
    while True:
        image = multiply(block)
        passes += 1
        # Rayleigh-Ritz: the eigenpairs of V on the block's space, largest first.
        small = block.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(ritz[0], 0.0)
        residual = np.linalg.norm((image - block * ritz)[:, :wanted], axis=0).max(initial=0.0)
        share = residual / top if top else 0.0
        if share <= TOLERANCE or width == places or (share <= ROUGH and share >= before):
            return Components(block[:, :wanted], np.maximum(ritz[:wanted], 0.0), float(share), passes)
        rounds, before = rounds + 1, share
        if rounds % ROUNDS == 0:
            more = min(places, 2 * width) - width
            block = np.linalg.qr(np.hstack([block, rng.standard_normal((places, more))]))[0]
            width, before = width + more, math.inf
            continue
        # The filter on [0, a]: three terms, scaled so that the largest direction keeps its size.
        half = max(ritz[-1], NOTHING * top) / 2
        reach = math.acosh(max((top - half) / half, 1.0 + 1e-12))
        degree = max(2, min(DEGREE, int(math.log(GAIN) / reach)))
        first = half / (top - half)
        scale = first
        old, now = block, (image - half * block) * (scale / half)
        for _ in range(degree - 1):
            following = 1.0 / (2.0 / first - scale)
            image = multiply(now)
            passes += 1
            old, now = now, (image - half * now) * (2 * following / half) - old * (scale * following)
            scale = following
        block = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]


def _whitener(of: Fit, base: np.ndarray, explained: list[float], error: float | None):
    """The rows of each block: every vector with every component."""
    components = base.shape[1]
    mean = of.over / of.n

    def deviations(table: np.ndarray) -> list[int | None]:
        """Sums over places of (n x - S)^2, exact; none where 38 digits do not hold it."""
        rough = (((np.abs(table.astype(np.float64)) + 1) * of.n) ** 2).sum(axis=1)
        table = table.astype(np.int64)
        if rough.max(initial=0.0) < 2.0**61:
            return (((of.n * table - of.over) ** 2).sum(axis=1)).tolist()
        found = ((of.n * table.astype(object) - of.over.astype(object)) ** 2).sum(axis=1).tolist()
        return [x if x < 10**38 else None for x in found]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in _OUT.split(", ")]
        step = max(1, ROWS_AT_ONCE // max(1, components))
        for ids, table in _tables(batches, of):
            for at in range(0, len(table), step):
                own = table[at : at + step]
                white = (own.astype(np.float64) - mean) @ base
                count = own.shape[0]
                exact = [None if d is None else Decimal(d) for d in deviations(own)]
                place = pa.array(np.repeat(np.arange(count), components))
                values = pa.array(white.ravel(), from_pandas=True)  # not a number: null
                columns = [
                    ids.values.slice(at, count).take(place),
                    pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * components, of.n)),
                    pa.array(exact, pa.decimal128(38, 0)).take(place),
                    values,
                    pa.array(np.tile(explained, count), pa.float64()),
                    pa.array([error] * (count * components), pa.float64()),
                ]
                yield pa.record_batch(columns, names)

    return rows


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every kept vector and component.

    ``vectors`` has ``vec_id`` and ``embedding``, an array of numbers.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    of = fit(rows.select("embedding"))
    if not of.n or not of.places:
        return vectors.sparkSession.createDataFrame([], _OUT)
    blocks = stored(rows.mapInArrow(_blocks(of), _BLOCK), "vectors")
    tasks = blocks.rdd.getNumPartitions()

    def multiply(block: np.ndarray) -> np.ndarray:
        return total(blocks, tasks, of, lambda x: x.T @ (x @ block), block.shape) / of.n

    found = leading(multiply, of.places, components)
    variance = total(blocks, tasks, of, lambda x: np.array([(x * x).sum()]), (1,))[0] / of.n
    varies = found.values > NOTHING * max(found.values.max(initial=0.0), 0.0)
    scale = np.where(varies, np.sqrt(np.where(varies, found.values, 1.0)), np.nan)
    base = found.vectors / scale
    kept = base[:, varies]
    error = None
    if kept.shape[1]:

        def products(x: np.ndarray) -> np.ndarray:
            white = x @ kept
            return np.vstack([white.sum(axis=0), white.T @ white])

        sums = total(blocks, tasks, of, products, (1 + kept.shape[1], kept.shape[1])) / of.n
        covariance = sums[1:] - np.outer(sums[0], sums[0])
        error = float(np.abs(covariance - np.eye(kept.shape[1])).max())
    explained = np.where(varies, found.values / variance if variance else 0.0, 0.0).tolist()
    return blocks.mapInArrow(_whitener(of, base, explained, error), _OUT)
