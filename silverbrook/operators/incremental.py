"""Incremental reading and merging by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKBACK_SECONDS = 15


def look_back_from(newest: Column, seconds: int = LOOKBACK_SECONDS) -> Column:
    """The oldest time that is still taken, given the newest known one; the epoch when there is none."""
    return F.coalesce(newest - F.make_dt_interval(secs=F.lit(seconds)), F.timestamp_seconds(F.lit(0)))


def _lower_bound(target: DataFrame, time_col: str, seconds: int) -> Column:
    """Target maximum less the look-back, as an uncorrelated scalar subquery.

    The default for an empty target sits inside the subquery, so the filter
    has the shape ``time >= subquery`` that Spark hands to the Parquet reader.
    """
    return target.agg(look_back_from(F.max(time_col), seconds).alias("bound")).scalar()


def lookback_filter(
    source: DataFrame,
    target: DataFrame,
    time_col: str,
    seconds: int = LOOKBACK_SECONDS,
    target_time_col: str | None = None,
) -> DataFrame:
    """Source rows no more than ``seconds`` older than the newest target row.

    Rows without a time are dropped, and rows older than the bound are never
    picked up, even for a new key; a full refresh recovers them.
    """
    bound = _lower_bound(target, target_time_col or time_col, seconds)
    return source.filter(F.col(time_col) >= bound)


def skipped_late(
    source: DataFrame,
    target: DataFrame,
    time_col: str,
    seconds: int = LOOKBACK_SECONDS,
    target_time_col: str | None = None,
) -> DataFrame:
    """One row counting what ``lookback_filter`` leaves out: old rows and rows without a time."""
    bound = _lower_bound(target, target_time_col or time_col, seconds)
    late = F.col(time_col) < bound
    return source.agg(
        F.count_if(late).alias("late_rows"),
        F.count_if(F.col(time_col).isNull()).alias("untimed_rows"),
    )


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch.

    Keys are unique on both sides, so no key can be hot; the batch side turns
    into a broadcast at run time when it is small.
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch)
