"""Tables that are rebuilt or merged without a moment when they are half written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverbrook.operators.dedup import latest_per_key
from silverbrook.operators.incremental import merge_upsert

VERSION = "table_version"
#: Rows of merged batches, as a share of the base, beyond which they are folded into it.
FOLD_SHARE = 0.25
#: Batches that a reader puts together at most.
BATCHES = 16

Check = Callable[[DataFrame], None]
Counts = Mapping[str, int] | Callable[[], Mapping[str, int]]


@dataclass(frozen=True)
class Version:
    """One commit: the folders of the base and of the batches merged since, and how they go together."""

    number: int
    base: str
    rows: int
    batches: tuple[str, ...] = ()
    batch_rows: int = 0
    #: Microseconds of the newest time that was ever committed since the last replacement.
    newest: int | None = None
    schema: Mapping = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    time_col: str | None = None
    newest_by: str | None = None
    tie_break: tuple[str, ...] = ()
    #: Whether all rows went through a check.
    checked: bool = False
    counts: Mapping[str, int] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return self.struct.names

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(self.schema)


class VersionedTable:
    """Parquet table whose versions are written aside and then switched to.

    A merge writes its batch alone, next to what is there; readers put base and
    batches together by key (merge on read). Only the few keys of the batches
    take part: all other rows of the base pass by a join with those keys, which
    are broadcast while they are small. Batches that grow beyond ``FOLD_SHARE``
    of the base are folded into a new base, more than ``BATCHES`` of them into
    one, so a row is rewritten a few times only while the table doubles.

    Keys belong to the table: they are stored with it and another choice is
    refused. With ``time_col`` every commit knows the newest time, as seen while
    writing, so that nobody has to scan for it.

    A commit is one small file, so a run that dies before it leaves the old
    version in place. One writer at a time: two at once may both find a commit
    number free, and the later one wins; nothing here prevents that.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str] = (), time_col: str | None = None
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.time_col = time_col

    def version(self, number: int | None = None) -> Version | None:
        """The newest commit, or that of a number; None while there is none."""
        number = max(self._commits(), default=None) if number is None else number
        if number is None:
            return None
        about = json.loads(self.spark.read.text(f"{self.path}/commits/{number}").first()[0])
        lists = {name: tuple(about[name]) for name in ("batches", "keys", "tie_break")}
        found = Version(**{**about, **lists})
        if found.keys != self.keys:
            raise ValueError(f"{self.path} has the keys {found.keys}, not {self.keys}")
        return found

    def exists(self) -> bool:
        return bool(self._commits())

    def read(self) -> DataFrame:
        """The committed rows."""
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"no committed version in {self.path}")
        return self._resolved(version)

    def newest(self) -> Column | None:
        """The newest time of the committed rows as a literal, from the commit alone."""
        version = self.version()
        if version is None or self.time_col is None:
            return None
        if version.time_col != self.time_col:
            return F.lit(self._resolved(version).agg(F.max(self.time_col)).first()[0])
        return F.timestamp_micros(F.lit(version.newest).cast("bigint"))

    def _rows(self, folders: Sequence[str], version: Version, with_version: bool = False) -> DataFrame:
        schema = StructType(version.struct.fields)
        if with_version:
            schema = schema.add(VERSION, "string")
        data = f"{self.path}/data"
        rows = self.spark.read.schema(schema).option("basePath", data)
        return rows.parquet(*[f"{data}/{folder}" for folder in folders]).select(*schema.names)

    def _latest_of(self, folders: Sequence[str], version: Version) -> DataFrame:
        """The rows of batches, one per key."""
        if version.newest_by is not None:
            rows = self._rows(folders, version)
            return latest_per_key(rows, self.keys, version.newest_by, "last", version.tie_break)
        rows = self._rows(folders, version, with_version=True)
        number = F.split_part(VERSION, F.lit("-"), F.lit(1)).cast("int")
        return latest_per_key(rows.withColumn(VERSION, number), self.keys, VERSION).drop(VERSION)

    def _merged(self, base: DataFrame, folders: Sequence[str], version: Version) -> DataFrame:
        """``base`` with the rows of batches."""
        latest = self._latest_of(folders, version)
        if version.newest_by is None:
            return merge_upsert(base, latest, self.keys)
        keys = self._rows(folders, version).select(*self.keys)
        there = base.join(keys, list(self.keys), "left_semi").select(*base.columns)
        winners = latest_per_key(
            there.unionByName(latest), self.keys, version.newest_by, "last", version.tie_break
        )
        others = base.join(keys, list(self.keys), "left_anti").select(*base.columns)
        return others.unionByName(winners)

    def _folded(self, base: DataFrame, folder: str, version: Version) -> DataFrame:
        """``base`` with the rows of one large batch: both are moved once and ranked together.

        Gives what ``_merged`` does, which reads and moves the base twice and the batch up to
        three times, as is right for a few keys. Rows without a key are never replaced.
        """
        keyed = " AND ".join(f"`{k}` IS NOT NULL" for k in self.keys)
        new = self._rows([folder], version)
        rows = base.filter(keyed).withColumn(VERSION, F.lit(0)).unionByName(new.withColumn(VERSION, F.lit(1)))
        if version.newest_by is None:
            latest = latest_per_key(rows, self.keys, VERSION)
        else:
            order = (version.newest_by, "last", version.tie_break)
            latest = latest_per_key(rows.drop(VERSION), self.keys, *order)
        return latest.select(*version.names).unionByName(base.filter(f"NOT ({keyed})"))

    def _resolved(self, version: Version) -> DataFrame:
        base = self._rows([version.base], version)
        return self._merged(base, version.batches, version) if version.batches else base

    def _write(self, df: DataFrame, number: int) -> tuple[str, int, int | None]:
        """Write rows into a new folder; its name, their number and the newest time."""
        folder = f"{VERSION}={number}-{uuid.uuid4().hex[:8]}"
        counted = [F.count(F.lit(1)).alias("rows")]
        if self.time_col is not None:
            newest = F.max(F.col(self.time_col).cast("timestamp"))
            counted.append(F.unix_micros(newest).alias("newest"))
        seen = Observation()
        df.observe(seen, *counted).write.parquet(f"{self.path}/data/{folder}")
        found = seen.get
        if "rows" not in found:  # Spark may drop the observation of an input that it knows to be empty
            written = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{folder}")
            found = written.agg(*counted).first().asDict()
        return folder, found["rows"], found.get("newest")

    def _commit(self, version: Version) -> None:
        line = F.lit(json.dumps(asdict(version))).alias("value")
        commit = self.spark.range(1).select(line).coalesce(1)
        commit.write.mode("errorifexists").text(f"{self.path}/commits/{version.number}")

    def replace(
        self,
        df: DataFrame,
        require_keys: bool = False,
        check: Check | None = None,
        counts: Counts | None = None,
    ) -> None:
        """Make ``df`` the whole content.

        ``require_keys`` refuses rows without a key. ``check`` sees the new rows
        before anyone else can: when it raises, the old version stays.
        """
        before = self.version()
        number = before.number + 1 if before else 1
        base, rows, newest = self._write(df, number)
        version = Version(
            number,
            base,
            rows,
            newest=newest,
            schema=df.schema.jsonValue(),
            keys=self.keys,
            time_col=self.time_col,
            checked=check is not None,
        )
        self._check([base], version, require_keys, check)
        self._commit(replace(version, counts=_known(counts)))

    def merge(
        self,
        batch: DataFrame,
        newest_by: str | None = None,
        tie_break: Sequence[str] = (),
        check: Check | None = None,
        counts: Counts | None = None,
    ) -> None:
        """Update rows by key and insert the rest.

        With ``newest_by`` the newer of the stored and the new row stays, and a
        stored row without a time gives way to any; without, the new row always
        stays. Merging the same batch again changes nothing. ``check`` sees the
        batch; rows that an earlier check saw are not tested again, and keys are
        unique by construction. ``counts``, or what it returns once the batch
        was computed, are kept with the commit.
        """
        before = self.version()
        if before is None:
            self.replace(batch, require_keys=True, check=check, counts=counts)
            return
        number = before.number + 1
        folder, rows, newest = self._write(batch.select(*before.names), number)
        self._check([folder], before, True, check if rows else None)
        found = _known(counts)
        if not rows and not any(found.values()):
            return
        after = replace(
            before,
            number=number,
            newest=max((t for t in (before.newest, newest) if t is not None), default=None),
            time_col=self.time_col if before.time_col == self.time_col else None,
            newest_by=newest_by,
            tie_break=tuple(tie_break),
            checked=before.checked and check is not None,
            counts=found,
        )
        if rows:
            other_rule = (before.newest_by, before.tie_break) != (newest_by, after.tie_break)
            grown = before.batch_rows + rows > FOLD_SHARE * before.rows
            if grown or before.batches and other_rule:
                whole = self._folded(self._resolved(before), folder, after)
                base, rows, newest = self._write(whole, number)
                after = replace(after, base=base, rows=rows, newest=newest, batches=(), batch_rows=0)
            else:
                batches = (*before.batches, folder)
                if len(batches) > BATCHES:
                    together, rows, _ = self._write(self._latest_of(batches, after), number)
                    after = replace(after, batches=(together,), batch_rows=rows)
                else:
                    after = replace(after, batches=batches, batch_rows=before.batch_rows + rows)
            if check is not None and not before.checked:
                check(self._resolved(after))
                after = replace(after, checked=True)
        self._commit(after)

    def _check(self, folders: Sequence[str], version: Version, with_keys: bool, check: Check | None) -> None:
        rows = self._rows(folders, version)
        if with_keys:
            missing = rows.filter(" OR ".join(f"`{k}` IS NULL" for k in self.keys))
            if not missing.isEmpty():
                raise ValueError(f"rows without a key ({', '.join(self.keys)}) cannot be merged")
        if check is not None:
            check(rows)

    def clean(self, keep: int = 2) -> None:
        """Delete what the newest ``keep`` commits do not refer to.

        Readers that still use an older version must be done; nothing else may
        write meanwhile.
        """
        commits = sorted(self._commits())
        kept = [self.version(n) for n in commits[-keep:]]
        folders = {f for v in kept for f in (v.base, *v.batches)}
        files, data = self._hadoop("data/*")
        for status in (files.globStatus(data) or []) if kept else []:
            if status.getPath().getName() not in folders:
                files.delete(status.getPath(), True)
        for number in commits[:-keep]:
            files.delete(self._hadoop(f"commits/{number}")[1], True)

    def _commits(self) -> list[int]:
        """The numbers of the commits, from file names alone."""
        files, parts = self._hadoop("commits/*/part-*")
        return sorted({int(s.getPath().getParent().getName()) for s in files.globStatus(parts) or []})

    def _hadoop(self, below: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path


def _known(counts: Counts | None) -> dict[str, int]:
    return dict(counts() if callable(counts) else counts or {})
