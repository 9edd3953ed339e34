"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at both ends, A-Z lower-cased. Of
a key that stands in several documents only the lines in the document with the
smallest id stay (all of them, should that document repeat it); keys under
``MIN_CHARS`` code points are left alone.

What has been seen is kept as runs: tables of (hash, owner) bucketed and sorted
by hash, all into as many buckets. A batch reduces its own lines to one owner per
hash, deals them to the buckets and sorts them once, and merge-joins them with
one run after the other; the runs are read in their order and neither moved nor
sorted. The hashes that no run has, which still lack an owner then, are a new run
of level 0. When a level has ``fan`` runs they are merged, bucket by bucket, into one
run of the next level, so a hash is rewritten once per level and a batch meets
few runs. Batches must come in ascending doc_id order for the smallest id to stay.

A key that fills a third of all lines is reduced to one row per task before any
shuffle; joining owners back to the lines leaves its many lines on the side
that adaptive execution can split. Texts move once, to meet their own drops.

Defined cases: a null or empty text is one empty line; rows without doc_id own
lines as one document after all others; rows that repeat a doc_id own lines as
one document. Each text has drops of its own all the same, so that no row
collects what many rows lose. A batch without rows adds nothing; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.llm.common import NO_ID, SPACE_CHARS, stored
from silverbrook.session import shared_dir

#: Keys of fewer code points are never dropped.
MIN_CHARS = 10
#: Runs of a level that are merged into one of the next.
FAN = 2
#: Documents are taken in so many batches by the registered query.
BATCHES = 4
#: Buckets of a run at least; one task reads one bucket of every run.
BUCKETS = 64

_SPACE = SPACE_CHARS.encode()
_RUN = "hash binary, owner long"


def line_hash(line: str) -> bytes | None:
    """The hash of a line's key; None for a key that is too short to count."""
    key = line.strip(SPACE_CHARS)
    if len(key) < MIN_CHARS:
        return None
    # lower() of bytes touches A-Z only.
    return hashlib.md5(key.encode("utf-8", "surrogatepass").lower(), usedforsecurity=False).digest()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids: list[int] = []
        rows: list[int] = []
        found: list[bytes] = []
        for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            own = {line_hash(line) for line in (text.as_py() or "").split("\n")} - {None}
            ids.extend([doc] * len(own))
            rows.extend([row] * len(own))
            found.extend(own)
        columns = [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(found, pa.binary())]
        yield pa.record_batch(columns, ["doc", "text_hash", "hash"])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, dropped = [], [], []
        for text, drops in zip(batch.column("text"), batch.column("drops")):
            lines = (text.as_py() or "").split("\n")
            gone = set(drops.as_py() or ())
            kept = [x for x in lines if line_hash(x) not in gone] if gone else lines
            texts.append("\n".join(kept))
            counts.append(len(lines))
            dropped.append(len(lines) - len(kept))
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(texts, pa.large_string()).cast(batch.column("text").type),
                pa.array(counts, pa.int64()),
                pa.array(dropped, pa.int64()),
            ],
            ["doc_id", "text", "n_lines", "n_dropped"],
        )


def _with_doc(docs: DataFrame) -> DataFrame:
    """The rows with the document that owns their lines, and a hash of the text that tells its rows apart.

    Should two texts of one document share the hash, each is asked for the
    other's drops too, which its document loses anyway.
    """
    doc, text = F.coalesce(F.col("doc_id"), F.lit(NO_ID)), F.col("text").cast("string")
    return docs.select(doc.alias("doc"), "doc_id", text, F.xxhash64(text).alias("text_hash"))


class LineRuns:
    """The hashes seen so far, in levels of sorted runs.

    A run is a table of the session's catalog, whose files lie in the shared
    folder: Spark keeps buckets for tables only. It takes a bucket of one file
    as sorted where the session says so, which is set here. A run has as many
    buckets as the session's shuffles have partitions: more partitions than
    buckets would write many small files to each, and its joins would move and
    sort the runs.
    """

    def __init__(self, spark: SparkSession, fan: int = FAN, buckets: int | None = None) -> None:
        self.spark = spark
        self.fan = fan
        self.buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def seen(self) -> DataFrame:
        """Every hash of every run with its owner; a hash is in one run only."""
        found = self.spark.createDataFrame([], _RUN)
        for run in self.runs():
            found = found.unionByName(run)
        return found

    def with_owners(self, hashes: DataFrame) -> DataFrame:
        """``hashes`` with the owner that a run has, null where none has."""
        found = hashes.withColumn("owner", F.lit(None).cast("long"))
        for run in self.runs():
            held = run.withColumnRenamed("owner", "held").hint("merge")
            found = found.join(held, "hash", "left").withColumn("owner", F.coalesce("owner", "held")).drop("held")
        return found

    def close(self) -> None:
        """Take the runs out of the catalog; their files stay like all working files."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names.clear()
        self.levels.clear()

    def add(self, owners: DataFrame) -> None:
        """Store a new run and merge levels that are full."""
        self._put(0, owners.repartition(self.buckets, "hash"))
        level = 0
        while len(self.levels[level]) >= self.fan:
            # No hash is in two runs: a full join of sorted buckets is their merge.
            merged, *others = self.levels[level]
            for run in others:
                other = run.withColumnRenamed("owner", "other")
                merged = merged.join(other.hint("merge"), "hash", "full_outer").select(
                    "hash", F.coalesce("owner", "other").alias("owner")
                )
            self.levels[level] = []
            self._put(level + 1, merged)
            level += 1

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        writer = run.write.bucketBy(self.buckets, "hash").sortBy("hash")
        writer.option("path", shared_dir(self.spark, f"line-run-{level}")).saveAsTable(name)
        self.names.append(name)
        self.levels[level].append(self.spark.table(name))


def find_drops(batch: DataFrame, runs: LineRuns) -> DataFrame:
    """(doc, text_hash, drops): the hashes each text of the batch loses; the batch's own go into the runs."""
    rows = _with_doc(batch).select("doc", "text_hash", "text")
    pairs = stored(rows.mapInArrow(_hashes, "doc long, text_hash long, hash binary"), "line-hashes")
    first = pairs.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    # Dealt to the buckets once; the joins with all runs keep that.
    first = first.repartition(runs.buckets, "hash")
    met = stored(runs.with_owners(first), "line-owners")
    runs.add(met.filter("owner IS NULL").select("hash", F.col("first").alias("owner")))
    # Most hashes stand in one document and need no second look.
    owners = met.filter("owner IS NOT NULL OR first < last").select(
        "hash", F.coalesce("owner", "first").alias("owner")
    )
    lost = pairs.join(owners.hint("merge"), "hash").filter("doc <> owner")
    return lost.groupBy("doc", "text_hash").agg(F.collect_set("hash").alias("drops"))


def rewrite(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """doc_id, text (the lines that stay), n_lines (before), n_dropped."""
    joined = _with_doc(docs).join(drops, ["doc", "text_hash"], "left").select("doc_id", "text", "drops")
    return joined.mapInArrow(_rewritten, "doc_id long, text string, n_lines long, n_dropped long")


def line_dedup(docs: DataFrame, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """Dedup the lines of all documents, taken in batches of ascending doc_id.

    Columns: doc_id, text, n_lines, n_dropped.
    """
    runs = LineRuns(docs.sparkSession, fan)
    cuts = docs.select(
        F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)
    ).first()[0] if batches > 1 else None
    doc = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    edges = [None, *sorted(set(cuts or [])), None]
    drops = None
    for low, high in zip(edges, edges[1:], strict=False):
        batch = docs
        if low is not None:
            batch = batch.filter(doc > F.lit(low))
        if high is not None:
            batch = batch.filter(doc <= F.lit(high))
        found = stored(find_drops(batch, runs), "line-drops")
        drops = found if drops is None else drops.unionByName(found)
    runs.close()
    return rewrite(docs, drops)
