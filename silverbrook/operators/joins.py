"""Joining many rows to one row per key when one key may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks a hot key is spread over when salted.
SALTS = 8


def left_join_one(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    spread_by: Sequence[str],
    salted: bool | None = None,
) -> DataFrame:
    """``many`` left join ``one`` on a key that is unique in ``one``.

    Adaptive execution broadcasts ``one`` when it measured it as small, and
    otherwise splits a partition of ``many`` that came out too large, be it by
    a hot key or by rows without one; ``one`` has a row per key, so nothing
    can go wrong on its side.

    ``salted`` spreads every key over ``SALTS`` tasks from the start, for
    sessions without adaptive execution, at the price of as many copies of
    ``one``; no pass counts rows first. Those copies are shuffled and sorted,
    never broadcast: planning would judge them by the size of ``one`` alone.
    ``spread_by`` names columns that tell the rows of ``many`` apart; salts are
    hashes of them, so a task that is run again computes the same ones.

    The result has the columns of ``many`` and those of ``one`` but its key.
    """
    right = one.withColumnRenamed(one_key, "_one_key")
    on = F.col(many_key) == F.col("_one_key")
    if not salted:
        return many.join(right, on, "left").drop("_one_key")
    left = many.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("_one_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = left.join(copies.hint("merge"), on & (F.col("_salt") == F.col("_one_salt")), "left")
    return joined.drop("_one_key", "_salt", "_one_salt")
