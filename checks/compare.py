"""Run the registered queries against their SQL and report differences.

``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.runs import QUERIES


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("silverbrook")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def _cell(value: object) -> object:
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    """Empty when the query gives exactly what its SQL gives."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return ""
    answer = con.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    want = _rows(names, answer.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}; first {got[:1]} / {want[:1]}"
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(wrong)} rows differ; first {wrong[0]}" if wrong else ""


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in args[1:] or QUERIES:
        start = time.perf_counter()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "" if name in ORACLES else " (no SQL)"
        print(f"{name}{kind}: {problem or 'ok'} [{time.perf_counter() - start:.1f}s]", flush=True)
    print(f"{bad} of {len(args[1:]) or len(QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
