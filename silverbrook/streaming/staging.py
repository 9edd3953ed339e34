"""Streaming forms of the staging jobs."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silverbrook.operators.dedup import earliest_per_key
from silverbrook.operators.incremental import LOOKBACK_SECONDS
from silverbrook.plans.staging import (
    EVENT_TIME,
    clicks_dedup,
    clicks_projection,
    stage_new_events,
    typed_versions,
)
from silverbrook.schema import EntitySpec
from silverbrook.sources.raw_events import good_events
from silverbrook.sources.tables import Check, VersionedTable
from silverbrook.streaming.landing import CLICKS_INTERVAL, start, start_append, write_batch

# A merge writes its batch alone, but readers put batches together: fewer are better for them.
MERGE_INTERVAL = "10 minutes"
SLICES = 16


def read_landing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The landing table as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def stream_clicks(
    landed: DataFrame, path: str, checkpoint: str, interval: str | None = CLICKS_INTERVAL
) -> StreamingQuery:
    """Append typed click rows as they land; nothing is shuffled or kept in state."""
    return start_append(clicks_projection(landed), path, checkpoint, interval=interval)


def first_click_seen(landed: DataFrame, watermark: str) -> DataFrame:
    """Click rows with repeats dropped that arrive within the watermark.

    ``watermark`` is how late a click may come behind the newest one. Later
    clicks are dropped, first arrivals too: ``dropped_by_watermark`` counts
    them. ``stream_first_clicks`` keeps them aside instead.

    Keeps the first arrival of a click; ``stream_clicks_latest`` keeps the
    latest event instead. Repeats are first dropped within slices of the
    input, so that a click repeated very often is not left to a single task; a
    row's slice follows from its partition and is the same when a task is run
    again.
    """
    clicks = clicks_projection(landed).withWatermark("ce_time", watermark)
    sliced = clicks.withColumn("_slice", F.spark_partition_id() % SLICES)
    once_per_slice = sliced.dropDuplicatesWithinWatermark(["click_id", "_slice"])
    return once_per_slice.drop("_slice").dropDuplicatesWithinWatermark(["click_id"])


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that came too late for a query's watermark, as far as its progress reports go back."""
    reports = [p.stateOperators for p in query.recentProgress]
    # Dropped rows are counted by the first stateful operator that meets them.
    return sum(int(s.numRowsDroppedByWatermark) for operators in reports for s in operators)


def stream_first_clicks(
    landed: DataFrame,
    table: VersionedTable,
    late: str,
    checkpoint: str,
    watermark: str,
    interval: str | None = CLICKS_INTERVAL,
) -> StreamingQuery:
    """Keep the first arrival of each click in a table, and late clicks in files below ``late``.

    The watermark is the newest time that the table has committed less
    ``watermark``, the time that a stream's own watermark has. In the same pass
    over a micro-batch, rows behind it, and rows without an id, go to ``late``;
    of the others those are added whose click the table has not seen since the
    watermark, so that only the table's newest rows are looked at. A click that
    comes again later is kept again. The table needs the keys (click_id, ce_id)
    and the time column ce_time. Each commit names its micro-batch: a repeated
    one changes nothing.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        before = table.version()
        if before is not None and before.counts.get(query, -1) >= batch_id:
            return
        aside = F.col("click_id").isNull() | F.col("ce_id").isNull()
        known = None
        if before is not None:
            bound = table.newest() - F.expr(f"INTERVAL {watermark}")
            aside = aside | F.coalesce(F.col("ce_time") < bound, F.lit(False))
            known = table.read().filter(F.col("ce_time") >= bound).select("click_id")
        held = batch.persist(StorageLevel.DISK_ONLY)
        try:
            write_batch(held.filter(aside), late, batch_id)
            first = earliest_per_key(held.filter(~aside), ["click_id"], "ce_time", ["ce_id"])
            if known is not None:
                first = first.join(known, "click_id", "left_anti").select(*held.columns)
            table.merge(first, counts={query: batch_id})
        finally:
            held.unpersist()

    return start(clicks_projection(landed).writeStream.foreachBatch(add), checkpoint, interval)


def missed_clicks(late: DataFrame, kept: DataFrame) -> DataFrame:
    """Late clicks none of whose rows was kept, the latest event of each; the landing table is not read."""
    return clicks_dedup(late).join(kept.select("click_id"), "click_id", "left_anti")


def stream_clicks_latest(
    landed: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    interval: str | None = MERGE_INTERVAL,
) -> StreamingQuery:
    """Keep a table of the latest event per click.

    Repeating a micro-batch merges the same rows again and changes nothing.
    Where clicks must show up sooner, append them with ``stream_clicks`` and
    read the table through ``clicks_dedup``.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        table.merge(clicks_dedup(batch), newest_by="ce_time", tie_break=["ce_id"])

    return start(clicks_projection(landed).writeStream.foreachBatch(merge), checkpoint, interval)


def stream_entity(
    raw: DataFrame,
    spec: EntitySpec,
    table: VersionedTable,
    checkpoint: str,
    interval: str | None = MERGE_INTERVAL,
    strict: bool = True,
    number_scale: int = 2,
    lookback_seconds: int = LOOKBACK_SECONDS,
    check: Check | None = None,
) -> StreamingQuery:
    """Keep an entity's staging table up to date from a stream of its raw events.

    A run with ``interval=None`` takes the events added since the last one and
    stops; it never reads older ones again.

    A micro-batch is handed over as whole rows, of which a reader can no longer
    pick fields. A run that makes the table takes all events there are, none of
    them late, so it types them before: the reader then reads the fields alone.
    """
    typed = interval is None and spec.time_column == EVENT_TIME and not table.exists()
    events = good_events(raw)
    if typed:
        events = typed_versions(events, spec, strict, number_scale)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        stage_new_events(batch, spec, table, strict, number_scale, lookback_seconds, check, typed)

    return start(events.writeStream.foreachBatch(merge), checkpoint, interval)
