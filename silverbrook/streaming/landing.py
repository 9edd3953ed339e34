"""Streams from incoming event texts to the landing table, the file store and the quarantine.

One query reads the source, judges every event in one pass and appends the
verdicts to a table partitioned by day and target; each sink is a query of its
own on its part of that table. Spark's file sink commits a micro-batch as a
whole, so every sink gets each event exactly once, also after a restart, and
none waits for another. Days that all sinks have passed are dropped
(``forget_judged``), so the table does not grow for ever.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from silverbrook.functions.events import CONTENT
from silverbrook.operators.routing import LANDING, QUARANTINE, STORE, TARGET, judge_events
from silverbrook.schema import ROUTED_TYPES
from silverbrook.sources.event_store import (
    QUARANTINE_PARTITIONS,
    STORE_OPTIONS,
    STORE_PARTITIONS,
    quarantine_rows,
    store_rows,
)

LANDING_SCHEMA = "record_content variant, record_metadata variant, ingested_at timestamp"

# How often the sinks write, and how often the click table refreshes.
SINK_INTERVAL = "60 seconds"
CLICKS_INTERVAL = "1 minute"

# The day an event was judged, and the folders of micro-batches that were audited.
JUDGED_ON = "judged_on"
BATCH = "batch"

Audit = Callable[[DataFrame], object]


def landing_rows(routed: DataFrame, partition_key: str = "ce_id") -> DataFrame:
    """Events with their metadata; the load time stays NULL for streamed rows."""
    return routed.select(
        F.col(CONTENT),
        F.to_variant_object(
            F.struct(F.col("ce_type").alias("type"), F.col(partition_key).alias("id"))
        ).alias("record_metadata"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
    )


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Start a stream that runs every ``interval``, or once over what is there with ``None``."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch into a folder of its own; a repeated one replaces itself.

    The folder is named after the query too, so that one started afresh, which
    counts from 0 again, replaces nothing.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={query}-{batch_id}")


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of the micro-batches below ``path``, none if there are none."""
    make_folder(spark, path)
    rows = spark.read.schema(schema).parquet(path)
    return rows.drop(BATCH)


def start_audited(
    rows: DataFrame,
    path: str,
    refused: str,
    checkpoint: str,
    audit: Audit,
    interval: str | None = CLICKS_INTERVAL,
) -> StreamingQuery:
    """Append those micro-batches that pass an audit; the others are kept in ``refused``.

    ``audit`` sees a micro-batch before any reader does; what it returns is
    false when all is well. A refused micro-batch is written whole, stops
    nothing and is not seen again: the next ones are judged on their own.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.DISK_ONLY)
        try:
            if not held.isEmpty():
                write_batch(held, refused if audit(held) else path, batch_id)
        finally:
            held.unpersist()

    return start(rows.writeStream.foreachBatch(publish), checkpoint, interval)


def start_append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    partition_by: Iterable[str] = (),
    options: dict[str, str] | None = None,
    interval: str | None = SINK_INTERVAL,
) -> StreamingQuery:
    """Append a stream to files every ``interval``, or once over what is there with ``None``."""
    writer = (
        rows.writeStream.format(file_format)
        .option("path", path)
        .options(**(options or {}))
        .partitionBy(*partition_by)
        .outputMode("append")
    )
    return start(writer, checkpoint, interval)


def stream_landing(
    routed: DataFrame, path: str, checkpoint: str, interval: str | None = SINK_INTERVAL
) -> StreamingQuery:
    """Land routed events continuously as content and metadata."""
    return start_append(landing_rows(routed), path, checkpoint, interval=interval)


def stream_event_store(
    stored: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = SINK_INTERVAL,
    arrival: Column | None = None,
) -> StreamingQuery:
    """Write the other events as compressed JSON lines by entity and arrival date."""
    rows = store_rows(stored, arrival)
    return start_append(rows, root, checkpoint, "text", STORE_PARTITIONS, STORE_OPTIONS, interval)


def stream_quarantine(
    rejected: DataFrame,
    root: str,
    checkpoint: str,
    text: str = "value",
    interval: str | None = SINK_INTERVAL,
    arrival: Column | None = None,
) -> StreamingQuery:
    """Keep rejected records, compressed, by kind of error and arrival date."""
    return start_append(
        quarantine_rows(rejected, text, arrival),
        root,
        checkpoint,
        "json",
        QUARANTINE_PARTITIONS,
        {"compression": "gzip"},
        interval,
    )


def start_ingest(
    texts: DataFrame,
    base: str,
    checkpoints: str,
    routed_types: Iterable[str] = ROUTED_TYPES,
    interval: str | None = SINK_INTERVAL,
    arrival: Column | None = None,
) -> list[StreamingQuery]:
    """Validate and route a stream of event texts into all three sinks.

    Without an interval everything there is judged first, and then handed to
    the sinks; the judging query is the first of the list. ``arrival`` is the
    day of judging, the current date by default.
    """
    judged = judge_events(texts.select("value"), routed_types)
    # Only rejected events still need their text.
    judged = judged.withColumn("value", F.when(F.col(TARGET) == QUARANTINE, F.col("value")))
    day = F.current_date() if arrival is None else arrival
    # Partition columns stand last and in the order of the folders, as a stream that reads them has them.
    others = [c for c in judged.columns if c != TARGET]
    judged = judged.select(*others, day.alias(JUDGED_ON), TARGET)
    path = f"{base}/judged"
    judging = start_append(
        judged, path, f"{checkpoints}/judged", partition_by=[JUDGED_ON, TARGET], interval=interval
    )
    if interval is None:
        judging.awaitTermination()
    spark = texts.sparkSession
    make_folder(spark, path)

    def part(target: str) -> DataFrame:
        return spark.readStream.schema(judged.schema).parquet(path).filter(F.col(TARGET) == target)

    return [
        judging,
        stream_landing(part(LANDING), f"{base}/landing", f"{checkpoints}/landing", interval),
        stream_event_store(part(STORE), f"{base}/events", f"{checkpoints}/events", interval),
        stream_quarantine(
            part(QUARANTINE), f"{base}/quarantine", f"{checkpoints}/quarantine", interval=interval
        ),
    ]


def forget_judged(queries: list[StreamingQuery], spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Drop the days of the judged table that all sinks have passed, but the newest ``keep``; their names.

    ``queries`` are those of ``start_ingest``, running or done. The days are
    listed first; then every sink works off what is there, which it has
    committed when its turn is over. Days only ever grow at the newest, so
    nothing comes to an older one afterwards.
    """
    judged = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/judged/{JUDGED_ON}=*")
    files = judged.getFileSystem(spark._jsc.hadoopConfiguration())
    days = sorted(files.globStatus(judged) or [], key=lambda status: status.getPath().getName())
    passed = days[: max(0, len(days) - keep)]
    for query in queries[1:] if passed else []:
        if query.isActive:
            query.processAllAvailable()
        elif query.exception() is not None:
            raise RuntimeError("a sink has failed: nothing is dropped") from query.exception()
    for status in passed:
        files.delete(status.getPath(), True)
    return [status.getPath().getName().partition("=")[2] for status in passed]
