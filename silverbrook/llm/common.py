"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverbrook.session import shared_dir

# The six ASCII white-space characters, as a regular expression
# class and as the characters themselves.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Stands for a missing doc_id where ids are compared: after every other id.
NO_ID = 2**63 - 1

#: Texts that a worker has as Python strings at a time.
TEXTS_AT_ONCE = 512

#: Made in each task: texts in, whether each is kept out.
Decide = Callable[[list[str | None]], list[bool]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared working folder and read them back.

    Later steps then start from files that outlive any executor, and the rows
    are computed once however often they are used.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever it is called there."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def first_of_equal(df: DataFrame, *keys: str) -> DataFrame:
    """One row of each group of rows that agree on ``keys`` (null equals null).

    Which one is undefined when they differ elsewhere. A group limit before the
    shuffle leaves one row per key and task, so a hot key does no harm.
    """
    number = fresh(df, "_nth")
    ranked = df.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))))
    return ranked.filter(F.col(number) == 1).drop(number)


def keep_by_text(docs: DataFrame, prepare: Callable[[], Decide]) -> DataFrame:
    """The rows whose text is kept, with all their columns.

    Only texts go to the Python workers and only decisions come back, a few
    hundred texts at a time; ``prepare`` is called once a task.
    """

    @F.arrow_udf("boolean")
    def kept(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decide = prepare()
        try:
            for texts in batches:
                found: list[bool] = []
                for at in range(0, len(texts), TEXTS_AT_ONCE):
                    found.extend(decide(texts.slice(at, TEXTS_AT_ONCE).to_pylist()))
                yield pa.array(found, pa.bool_())
        finally:
            give_back()

    return docs.filter(kept(F.col("text").cast("string")))


def give_back() -> None:
    """Return what Arrow and the allocator hold free to the system: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def digest16(data: bytes) -> bytes:
    """128-bit content digest."""
    return hashlib.blake2b(data, digest_size=16).digest()
