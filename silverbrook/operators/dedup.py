"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType


def _sortable(name: str, data_type: DataType) -> Column:
    if isinstance(data_type, (VariantType, MapType)):
        return F.to_json(F.col(name))
    return F.col(name)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    nulls: str = "first",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep the row with the greatest ``order_col`` of each key.

    A NULL order value wins by default (``nulls="first"``), as in warehouses
    that sort NULL as the largest value. Ties go to the greatest ``tie_break``
    columns and then to all remaining columns, so the choice is total.

    Catalyst turns ``row_number() = 1`` into a group limit that runs before
    the shuffle, so every task sends at most one row per key and a hot key
    costs no more than one row per task.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    order = F.col(order_col)
    rest = [c for c in df.columns if c not in {*keys, order_col, *tie_break}]
    window = Window.partitionBy(*keys).orderBy(
        order.desc_nulls_first() if nulls == "first" else order.desc_nulls_last(),
        *[_sortable(c, types[c]).desc_nulls_last() for c in [*tie_break, *rest]],
    )
    return _first(df, window)


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the smallest ``order_col`` of each key; a NULL is larger than any.

    Ties go to the smallest ``tie_break`` columns, which should settle them.
    """
    order = [F.col(c).asc_nulls_last() for c in (order_col, *tie_break)]
    return _first(df, Window.partitionBy(*keys).orderBy(*order))


def _first(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
