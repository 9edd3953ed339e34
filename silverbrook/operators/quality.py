"""Data-quality tests: each returns the failing evidence, empty when all is well."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.schema import Column, EntitySpec


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a NULL are ignored."""
    return (
        df.select(*cols)
        .dropna()
        .groupBy(*cols)
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column, from one pass; columns without any are left out."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "n_nulls").filter("n_nulls > 0")


def check_accepted(df: DataFrame, col: str, values: Iterable[object]) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    return (
        df.filter(~F.col(col).isin(*values))
        .groupBy(F.col(col).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def run_tests(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """All declared tests of a table, one row per failed test."""
    return run_column_tests(df, spec.columns, spec.keys)


def run_column_tests(
    df: DataFrame, columns: Iterable[Column], keys: Sequence[str] = ()
) -> DataFrame:
    """The declared tests of columns and the uniqueness of keys, one row per failed test.

    Not-null and accepted-values tests share one pass over the table; only
    uniqueness needs a shuffle.
    """
    columns = list(columns)
    counters = [
        F.count_if(F.col(c.name).isNull()).alias(f"not_null:{c.name}") for c in columns if c.not_null
    ] + [
        F.count_if(~F.col(c.name).isin(*c.accepted)).alias(f"accepted_values:{c.name}")
        for c in columns
        if c.accepted
    ]
    passes = [df.agg(*counters)] if counters else []
    if keys:
        passes.append(check_unique(df, keys).agg(F.count("*").alias(f"unique:{','.join(keys)}")))
    parts = [counted.unpivot([], counted.columns, "label", "failures") for counted in passes]
    return (
        reduce(DataFrame.unionByName, parts)
        .filter("failures > 0")
        .select(
            F.split_part("label", F.lit(":"), F.lit(1)).alias("test"),
            F.split_part("label", F.lit(":"), F.lit(2)).alias("column_name"),
            "failures",
        )
    )


def check_entitlements(entitlements: DataFrame) -> DataFrame:
    """Failures of the entitlement table's constraints, one row per broken one."""
    key = ["user_id", "resource", "object_id"]
    parts = [
        check_accepted(entitlements, "access_level", (0, 1, 2)).select(
            F.lit("access_level").alias("check_name"),
            F.col("value_field").cast("string").alias("detail"),
            F.col("n_records").alias("failures"),
        ),
        check_not_null(entitlements, [*key, "access_level"]).select(
            F.lit("not_null").alias("check_name"),
            F.col("column_name").alias("detail"),
            F.col("n_nulls").alias("failures"),
        ),
        check_unique(entitlements, key).select(
            F.lit("primary_key").alias("check_name"),
            F.concat_ws("/", *key).alias("detail"),
            F.col("n_records").alias("failures"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def delivery_check(df: DataFrame, event_type: str, type_col: str, time_col: str) -> DataFrame:
    """Rows and newest time of one event type on a landing or staging table."""
    return df.filter(F.col(type_col) == event_type).agg(
        F.count("*").alias("row_count"), F.max(time_col).alias("latest")
    )
