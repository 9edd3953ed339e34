"""Reading event files, once or incrementally."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverbrook.functions.events import CONTENT, variant_field, with_computed
from silverbrook.operators.routing import one_document

RAW_SCHEMA = (
    "ingested_at timestamp, source_file string, record_content variant, "
    "ce_id string, ce_type string, ce_time timestamp, bad_line string"
)

# How long loaded files are remembered. A file that is older than
# the newest one by more than this when it is first seen is not loaded;
# ``unloaded_files`` finds such files and a full build reads them.
FILE_MEMORY = "64d"


def entity_prefix(root: str, entity: str) -> str:
    """The folder of one entity below the store's root; an empty key has Hive's name for it."""
    return f"{root.rstrip('/')}/entity={entity or '__HIVE_DEFAULT_PARTITION__'}"


def json_values(line: Column) -> Column:
    """The JSON values of a line that may hold several objects one after another.

    In valid JSON a brace closed and opened again is either the border of two
    values or part of a text. Control characters cannot occur as such, so they
    can stand for escapes while texts are told apart, and mark the borders.
    """
    plain = F.replace(F.replace(line, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    marked = F.regexp_replace(plain, r'("[^"]*")|(\})\s*(?=\{)', "$1$2\x03")
    marked = F.replace(marked, F.lit('"\x03'), F.lit('"'))
    escaped = F.replace(F.replace(marked, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    return F.when(line.rlike(r"\}\s*\{"), F.split(escaped, "\x03")).otherwise(F.array(line))


def with_event_columns(raw: DataFrame) -> DataFrame:
    """Add id, type and time as typed columns beside the event.

    The Parquet reader can skip row groups on a typed time, which it cannot
    on a field inside the variant.
    """
    return raw.select(
        "*",
        variant_field("$.id", "string", strict=False).alias("ce_id"),
        variant_field("$.type", "string", strict=False).alias("ce_type"),
        variant_field("$.time", "timestamp", strict=False).alias("ce_time"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """Load time, file and unmodified event of every JSON value; text that is none as a bad line.

    A piece must be exactly one value: what stands after it is not dropped but
    makes the piece a bad line. Blank lines are nothing.
    """
    located = lines.select(
        F.current_timestamp().alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
        F.explode(json_values(F.col("value"))).alias("value"),
    )
    located = located.filter(F.col("value").rlike(r"\S"))
    parsed = with_computed(located, CONTENT, one_document(F.col("value")))
    bad = F.when(F.col(CONTENT).isNull(), F.col("value")).alias("bad_line")
    columns = [c for c in parsed.columns if c != "value"]
    return with_event_columns(parsed.select(*columns, bad)).select(
        *columns, "ce_id", "ce_type", "ce_time", "bad_line"
    )


def good_events(raw: DataFrame) -> DataFrame:
    """The events of a raw table, without its bad lines."""
    if "bad_line" not in raw.columns:
        return raw
    return raw.filter("bad_line IS NULL").drop("bad_line")


def load_report(raw: DataFrame) -> DataFrame:
    """Events and bad lines of every loaded file of a raw table."""
    return raw.groupBy("source_file").agg(
        F.count_if(F.col("bad_line").isNull()).alias("n_events"),
        F.count_if(F.col("bad_line").isNotNull()).alias("n_bad_lines"),
    )


def unloaded_files(
    spark: SparkSession, root: str, entity: str, raw: DataFrame, prefix: str | None = None
) -> DataFrame:
    """Files of an entity (source_file, modified) of which the raw table has nothing.

    Names and times only are read. An empty file is one of them.
    """
    path = prefix or entity_prefix(root, entity)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = listed.select(
        F.col("_metadata.file_path").alias("source_file"), F.col("modificationTime").alias("modified")
    )
    return files.join(raw.select("source_file").distinct(), "source_file", "left_anti")


def unloaded_events(
    spark: SparkSession, root: str, entity: str, raw: DataFrame, prefix: str | None = None
) -> DataFrame:
    """The records of the files that ``unloaded_files`` finds."""
    path = prefix or entity_prefix(root, entity)
    records = _records(spark.read.option("recursiveFileLookup", "true").text(path))
    missed = unloaded_files(spark, root, entity, raw, prefix).select("source_file")
    return records.join(missed, "source_file", "left_semi")


def read_raw_events(
    spark: SparkSession, root: str, entity: str, prefix: str | None = None
) -> DataFrame:
    """All records below one entity's folder; ``read_bad_lines`` has what does not parse.

    Only that folder is listed. ``prefix`` names the folder itself when the
    store is laid out differently. A line may hold several objects; an array
    stays one record.
    """
    path = prefix or entity_prefix(root, entity)
    return good_events(_records(spark.read.option("recursiveFileLookup", "true").text(path)))


def read_bad_lines(
    spark: SparkSession, root: str, entity: str, prefix: str | None = None
) -> DataFrame:
    """(source_file, bad_line) of the lines, or parts of lines, that are not one JSON value."""
    path = prefix or entity_prefix(root, entity)
    records = _records(spark.read.option("recursiveFileLookup", "true").text(path))
    return records.filter("bad_line IS NOT NULL").select("source_file", "bad_line")


def load_raw_incremental(
    spark: SparkSession,
    root: str,
    entity: str,
    table: str,
    checkpoint: str,
    prefix: str | None = None,
    max_file_age: str = FILE_MEMORY,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append files not loaded before to a raw table; run again, it adds only new files.

    Bad lines are kept in the table beside the events: read it through
    ``good_events``, count them with ``load_report``.

    The checkpoint remembers the files and the file sink commits each batch as
    a whole, so a failed run neither loses nor repeats any. A large backlog
    can be taken in batches of ``files_per_batch``, so that a failure repeats
    one of them only.
    """
    path = prefix or entity_prefix(root, entity)
    lines = (
        spark.readStream.format("text")
        .schema("value string")
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", max_file_age)
    )
    if files_per_batch is not None:
        lines = lines.option("maxFilesPerTrigger", files_per_batch)
    return (
        _records(lines.load(path))
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
