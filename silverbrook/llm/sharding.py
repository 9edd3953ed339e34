"""Shards of near-equal bytes by sampled splitters.

Rows are ordered by (key, doc_id, a stored row number). Splitters come from a
sample in which a row's chance grows with its size: quantiles of the sampled
keys cut the rows into many fine ranges, the bytes of every range are counted
in full, and a range that came out too heavy, as one hot key makes it, is
subdivided by splitters over the whole order. Running sums within ranges plus
the exact totals of earlier ranges give each row its place in the global order
of bytes, and the shard is that place cut into equal parts. The sample only
decides how evenly the work is spread.

Rows of one key, by default equal texts, are a group and go whole into the shard
that holds the group's middle byte, as long as the group has at most
``GROUP_SHARE`` of a shard's bytes; larger ones, told by ``group_split``, go on
into the next shard. A shard's bytes differ from their due by less than a record
or half a whole group at either end, whatever the sample said.

The driver sees splitters and one total per range: their number follows
``RANGE_ROWS``, 24 bytes for each, not the rows. The chance of a row comes from
a hash, so a recomputed task draws the same sample.

Defined cases: a null text has no bytes; its size is 1 like that of an empty
one. Null ids order first, null keys too; rows equal in key and id are told
apart by a stored number. No rows give no shards. Other columns are kept by
``shard_rows`` whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import fresh, stored, text_or_empty

SHARDS = 16
#: Fine ranges: at least so many, and one for each so many rows.
MIN_RANGES = 256
RANGE_ROWS = 2_000_000
#: Sampled rows per fine range.
OVERSAMPLE = 32
#: A range heavier than so many times its due is subdivided.
OVERFULL = 2.0

#: Share of a shard's bytes up to which a group is kept whole.
GROUP_SHARE = 0.5

_LOW = -(2**63)
_ORDER = ["key", "id", "tie"]


@dataclass(frozen=True)
class Splitters:
    """Sorted lower bounds (key, id, tie) of the ranges from the second on."""

    bounds: np.ndarray

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The range of each row: binary search in lexicographic order, all rows at once."""
        low = np.zeros(len(rows), np.int64)
        high = np.full(len(rows), len(self.bounds), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            bound = self.bounds[np.minimum(middle, len(self.bounds) - 1)]
            below = _less(rows, bound)
            high = np.where(open_ & below, middle, high)
            low = np.where(open_ & ~below, middle + 1, low)
        return low

    def column(self) -> Column:
        @F.pandas_udf("long")
        def place(key: pd.Series, id_: pd.Series, tie: pd.Series) -> pd.Series:
            return pd.Series(self.place(np.stack([key, id_, tie], axis=1).astype(np.int64)))

        return place(*_ORDER)


def _less(rows: np.ndarray, bound: np.ndarray) -> np.ndarray:
    a, b, c = (rows[:, i] < bound[:, i] for i in range(3))
    same_key, same_id = rows[:, 0] == bound[:, 0], rows[:, 1] == bound[:, 1]
    return a | (same_key & (b | (same_id & c)))


def _sample(rows: DataFrame, expected: int, total: int, seed: int) -> DataFrame:
    """Rows drawn with a chance in proportion to their size, and the bytes each stands for."""
    draw = F.pmod(F.xxhash64(*_ORDER, F.lit(seed)), F.lit(2**40)) / F.lit(2.0**40)
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(expected / max(total, 1)))
    return rows.filter(draw < chance).select(*_ORDER, (F.col("size") / chance).alias("weight"))


def _quantiles(sample: pd.DataFrame, parts: int, whole_key: bool) -> np.ndarray:
    """Bounds that cut the weight of a sorted sample into equal parts."""
    if sample.empty or parts < 2:
        return np.empty((0, 3), np.int64)
    sample = sample.sort_values(_ORDER, kind="stable")
    weight = sample["weight"].to_numpy().cumsum()
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    bounds = sample[_ORDER].to_numpy(np.int64)[np.minimum(at, len(sample) - 1)].copy()
    if whole_key:
        bounds[:, 1:] = _LOW
    return np.unique(bounds, axis=0)


def _totals(rows: DataFrame, splitters: Splitters) -> pd.DataFrame:
    totals = rows.groupBy(splitters.column().alias("range")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )
    return totals.toPandas().set_index("range").sort_index()


def find_splitters(rows: DataFrame, ranges: int, total: int) -> tuple[Splitters, pd.DataFrame]:
    """Splitters of ranges that hold no more than their due, and each range's bytes and rows."""
    sample = _sample(rows, ranges * OVERSAMPLE, total, 0).toPandas()
    splitters = Splitters(_quantiles(sample, ranges, whole_key=True))
    due = total / ranges
    for seed in range(1, 5):
        totals = _totals(rows, splitters)
        heavy = totals[(totals["bytes"] > OVERFULL * due) & (totals["rows"] > 1)]
        if heavy.empty:
            break
        parts = np.ceil(heavy["bytes"] / due).astype(int)
        inside = rows.withColumn("range", splitters.column()).filter(F.col("range").isin([int(x) for x in heavy.index]))
        weight = int(heavy["bytes"].sum())
        drawn = _sample(inside, int(parts.sum()) * OVERSAMPLE, weight, seed).toPandas()
        where = splitters.place(drawn[_ORDER].to_numpy(np.int64))
        new = [_quantiles(drawn[where == r], int(parts[r]), whole_key=False) for r in heavy.index]
        bounds = np.unique(np.concatenate([splitters.bounds, *new]), axis=0)
        if len(bounds) == len(splitters.bounds):
            break
        splitters = Splitters(bounds)
    else:
        totals = _totals(rows, splitters)
    return splitters, totals


def sized_rows(docs: DataFrame, key: Column | None = None, number: Column | None = None) -> DataFrame:
    """What sharding needs of each row: id, size, key and a number that tells equal rows apart."""
    key = F.xxhash64(text_or_empty()) if key is None else key
    number = F.monotonically_increasing_id() if number is None else number
    rows = docs.select(
        "doc_id",
        (F.octet_length(text_or_empty()).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"),
        F.coalesce(key.cast("long"), F.lit(_LOW)).alias("key"),
        F.coalesce(F.col("doc_id"), F.lit(_LOW)).alias("id"),
        number.alias("tie"),
    )
    return stored(rows, "shard-rows")


def shard_places(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows of ``sized_rows`` with shard and slot (gapless from 0 within the shard)."""
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return rows.withColumns(
            {"shard": F.lit(0), "slot": F.lit(0).cast("long"), "group_split": F.lit(False)}
        )
    ranges = max(MIN_RANGES, -(-count // RANGE_ROWS))
    splitters, totals = find_splitters(rows, ranges, total)
    before = totals.cumsum() - totals
    spark = rows.sparkSession
    # One row per range, as many as there are splitters.
    starts = spark.createDataFrame(
        [(int(r), int(b), int(n)) for r, b, n in before.itertuples()],
        "range long, bytes_before long, rows_before long",
    )
    order = Window.partitionBy("range").orderBy(*_ORDER)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("range", splitters.column())
        .withColumns(
            {
                "local_bytes": F.coalesce(F.sum("size").over(earlier), F.lit(0)),
                "local_row": F.row_number().over(order) - 1,
            }
        )
        .join(F.broadcast(starts), "range")
        .select(
            *rows.columns,
            (F.col("bytes_before") + F.col("local_bytes")).alias("start"),
            (F.col("rows_before") + F.col("local_row")).alias("place"),
        )
    )
    placed = stored(placed, "shard-starts")
    groups = placed.groupBy("key").agg(
        F.count("*").alias("rows"), F.min("start").alias("group_start"), F.sum("size").alias("group_bytes")
    )
    groups = groups.filter("rows > 1").drop("rows")
    whole = F.col("group_bytes") <= F.lit(GROUP_SHARE * total / shards)
    # A group's rows follow one another, so that shards stay stretches of the order.
    byte = F.when(whole, F.col("group_start") + F.col("group_bytes") / 2).otherwise(F.col("start"))
    placed = placed.join(groups, "key", "left").select(
        *rows.columns,
        F.least(F.floor(byte * F.lit(shards) / F.lit(total)), F.lit(shards - 1)).cast("int").alias("shard"),
        "place",
        F.coalesce(~whole, F.lit(False)).alias("group_split"),
    )
    placed = stored(placed, "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("place") - F.col("first")).drop(
        "place", "first"
    )


def shard(docs: DataFrame, shards: int = SHARDS, key: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (always null) and group_split of every row.

    The law is ``bytes``: sizes near equal. By default rows are ordered by a
    hash of the text, and equal texts are in one shard unless there is too much
    of them for that (``group_split``).
    """
    return shard_places(sized_rows(docs, key), shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "group_split",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: Column | None = None) -> None:
    """Write whole rows, one folder per shard, their files in the order of the slots."""
    number, name, slot = fresh(docs, "_row"), fresh(docs, "shard"), fresh(docs, "slot")
    whole = stored(docs.withColumn(number, F.monotonically_increasing_id()), "shard-input")
    places = shard_places(sized_rows(whole, key, F.col(number)), shards)
    places = places.select(F.col("tie").alias(number), F.col("shard").alias(name), F.col("slot").alias(slot))
    placed = whole.join(places, number).drop(number).repartitionByRange(name, slot)
    placed.sortWithinPartitions(name, slot).write.partitionBy(name).parquet(path)
