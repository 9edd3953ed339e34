import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.bindings import Inputs
from silverbrook.functions.events import CONTENT, extract_typed
from silverbrook.operators.dedup import latest_per_key
from silverbrook.operators.incremental import lookback_filter, merge_upsert, skipped_late
from silverbrook.plans.staging import stage_entity, stage_new_events, staged
from silverbrook.schema import ENTITIES, Column
from silverbrook.sources import tables
from silverbrook.sources.raw_events import RAW_SCHEMA, with_event_columns
from silverbrook.sources.tables import VersionedTable
from silverbrook.streaming.staging import stream_entity
from tests.conftest import executed_plan

SPEC = ENTITIES["payments"]
START = datetime(2024, 1, 1)


def event(payment_id, seconds, amount, event_id="e", **more):
    time = None if seconds is None else (START + timedelta(seconds=seconds)).isoformat() + "Z"
    data = {"payment_id": payment_id, "order_id": 1, "payment_method": "coupon", "amount": amount, **more}
    return {"specversion": "1.0", "id": event_id, "source": "s", "type": "x.payment.upsert", "time": time, "data": data}


def raw(spark, *events):
    df = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    located = df.select(
        F.lit(None).cast("timestamp").alias("ingested_at"),
        F.lit(None).cast("string").alias("source_file"),
        F.parse_json("value").alias(CONTENT),
    )
    return with_event_columns(located)


def amounts(df):
    return {r["payment_id"]: None if r["amount"] is None else float(r["amount"]) for r in df.collect()}


@pytest.fixture
def table(spark, folder):
    return VersionedTable(spark, f"{folder}/payments", SPEC.keys, SPEC.time_column)


# Typed extraction


def test_extract_strict_raises_lenient_gives_null(spark):
    for bad in ([1], {"a": 1}, "many"):
        events = raw(spark, event(1, 0, bad))
        with pytest.raises(PySparkException):
            extract_typed(events, SPEC.columns).collect()
        assert extract_typed(events, SPEC.columns, strict=False).first()["amount"] is None


def test_extract_nulls_and_missing_paths(spark):
    row = extract_typed(raw(spark, event(1, 0, None)), [*SPEC.columns, Column("absent", "integer")]).first()
    assert row["amount"] is None and row["absent"] is None


def test_extract_number_scale(spark):
    events = raw(spark, event(1, 0, 12.5), event(2, 0, 13.5), event(3, 0, -2.5), event(4, 0, "7.25"))
    assert amounts(extract_typed(events, SPEC.columns)) == {1: 12.5, 2: 13.5, 3: -2.5, 4: 7.25}
    assert amounts(extract_typed(events, SPEC.columns, number_scale=0)) == {1: 13, 2: 14, 3: -3, 4: 7}


def test_extract_untyped_stays_variant_and_odd_names(spark):
    events = raw(spark, event(1, 0, 1, **{"odd name": 5, "nested": {"a": [1]}}))
    out = extract_typed(events, [Column("odd name", "integer"), Column("nested")])
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "variant"]
    assert out.select("`odd name`", F.to_json("nested")).first() == (5, '{"a":[1]}')


def test_extract_time_offsets_are_instants(spark):
    shifted = {**event(1, 0, 1), "time": "2024-01-01T02:00:00+02:00"}
    row = extract_typed(raw(spark, shifted), SPEC.columns).select(F.unix_seconds("ce_time")).first()
    assert row[0] == 1704067200


# Latest per key


def test_latest_null_time_first_or_last(spark, rows):
    df = spark.createDataFrame([(1, None, "n"), (1, 5, "t")], "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], "t"), "v") == [("n",)]
    assert rows(latest_per_key(df, ["k"], "t", nulls="last"), "v") == [("t",)]


def test_latest_ties_are_settled_the_same_way_every_time(spark, rows):
    data = [(1, 5, str(i), {"a": i}) for i in range(50)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, t int, v string, m map<string,int>").repartition(4)
        assert rows(latest_per_key(df, ["k"], "t"), "v") == [("9",)]


def test_latest_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "k int, t int")
    assert latest_per_key(df, ["k"], "t").count() == 2


def test_latest_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


# Look-back and merge


def test_lookback_bounds(spark, rows):
    source = spark.createDataFrame([(s, START + timedelta(seconds=s)) for s in (0, 84, 85, 100, 120)], "s int, t timestamp")
    target = spark.createDataFrame([(START + timedelta(seconds=100),)], "t timestamp")
    assert rows(lookback_filter(source, target, "t"), "s") == [(100,), (120,), (85,)]
    assert lookback_filter(source, target.limit(0), "t").count() == 5
    assert skipped_late(source, target, "t").first() == (2, 0)


def test_lookback_reaches_the_scan(spark, folder):
    df = spark.createDataFrame([(START,)], "t timestamp")
    df.write.parquet(f"{folder}/a")
    stored = spark.read.parquet(f"{folder}/a")
    plan = lookback_filter(stored, stored, "t")._jdf.queryExecution().executedPlan().toString()
    scans = [line.split("Format")[0] for line in plan.splitlines() if "DataFilters" in line]
    assert any("Subquery" in scan for scan in scans)


def test_merge_updates_and_inserts(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int")
    assert rows(merge_upsert(old, new, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]


# Staging runs


def test_incremental_rules(spark, table):
    first = [event(1, 100, 1, "a"), event(2, 95, 2, "b")]
    stage_entity(raw(spark, *first), SPEC, table)
    later = [
        event(2, 90, 20, "c"),  # in the look-back but older than the stored version
        event(3, 84, 30, "d"),  # later than the look-back allows, a new key
        event(4, 86, 40, "e"),  # just within it
        event(5, None, 50, "f"),  # no time
        event(1, 101, 10, "g"),
    ]
    everything = raw(spark, *first, *later)
    assert amounts(stage_entity(everything, SPEC, table)) == {1: 10, 2: 2, 4: 40}
    assert amounts(stage_entity(everything, SPEC, table)) == {1: 10, 2: 2, 4: 40}
    full = {1: 10, 2: 2, 3: 30, 4: 40, 5: 50}
    assert amounts(stage_entity(everything, SPEC, table, "full")) == full


def test_new_events_give_what_rereading_gives(spark, folder, table):
    batches = [
        [event(1, 100, 1, "a"), event(2, 95, 2, "b"), event(9, 20, 9, "z")],
        [event(2, 90, 20, "c"), event(3, 84, 30, "d"), event(4, 86, 40, "e")],
        [event(1, 100, 11, "b"), event(4, 86, 41, "a"), event(2, 130, 21, "x")],
        [event(6, 116, 6, "y"), event(7, 114, 7, "y")],
    ]
    other = VersionedTable(spark, f"{folder}/other", SPEC.keys)
    seen = []
    for batch in batches:
        seen += batch
        stage_entity(raw(spark, *seen), SPEC, other)
        stage_new_events(raw(spark, *batch), SPEC, table)
        assert amounts(staged(table.read(), SPEC)) == amounts(staged(other.read(), SPEC))
    stage_new_events(raw(spark, *batches[-1]), SPEC, table)  # a repeated micro-batch
    assert amounts(staged(table.read(), SPEC)) == amounts(staged(other.read(), SPEC))


def test_a_stored_row_without_time_gives_way(spark, folder, table):
    """Also for the merge of a stream: batch and stream agree."""
    other = VersionedTable(spark, f"{folder}/other", SPEC.keys)
    first = [event(1, None, 1, "a"), event(2, 100, 2, "b")]
    later = [event(1, 110, 9, "c")]
    stage_entity(raw(spark, *first), SPEC, other)
    stage_new_events(raw(spark, *first), SPEC, table)
    assert amounts(table.read()) == amounts(other.read()) == {1: 1, 2: 2}
    stage_entity(raw(spark, *first, *later), SPEC, other)
    stage_new_events(raw(spark, *later), SPEC, table)
    assert amounts(table.read()) == amounts(other.read()) == {1: 9, 2: 2}


def test_unreadable_times_raise_in_every_mode(spark, folder, table):
    bad = event(2, 100, 5, "x")
    bad["time"] = "yesterday"
    stage_entity(raw(spark, event(1, 100, 1, "a")), SPEC, table)
    for run in (
        lambda: stage_entity(raw(spark, bad), SPEC, table, "full"),
        lambda: stage_entity(raw(spark, bad), SPEC, table),
        lambda: stage_new_events(raw(spark, bad), SPEC, table),
    ):
        with pytest.raises(PySparkException):
            run()
    assert amounts(table.read()) == {1: 1}
    stage_new_events(raw(spark, bad), SPEC, table, strict=False)
    assert amounts(table.read()) == {1: 1}


def test_late_and_untimed_events_are_counted(spark, table):
    stage_new_events(raw(spark, event(1, 100, 1, "a")), SPEC, table)
    stage_new_events(raw(spark, event(2, 10, 2, "b"), event(3, None, 3, "c"), event(4, 99, 4, "d")), SPEC, table)
    stage_new_events(raw(spark, event(5, 10, 5, "e")), SPEC, table)  # nothing staged, still counted
    found = [table.version(n).counts for n in (1, 2, 3)]
    counts = [(c.get("late_rows", 0), c.get("untimed_rows", 0)) for c in found]
    assert counts == [(0, 0), (1, 1), (1, 0)] and amounts(table.read()) == {1: 1, 4: 4}
    stage_new_events(raw(spark, event(5, 10, 5, "e")), SPEC, table, lookback_seconds=1000)
    assert amounts(table.read()) == {1: 1, 4: 4, 5: 5}


def test_stream_equals_full_refresh(spark, folder, table):
    events = [event(i % 7, i, i, f"e{i}") for i in range(60)]
    for part in range(0, 60, 20):
        raw(spark, *events[part : part + 20]).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    stream = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/raw")
    stream_entity(stream, SPEC, table, f"{folder}/ckpt", None).awaitTermination()
    full = VersionedTable(spark, f"{folder}/full", SPEC.keys)
    stage_entity(raw(spark, *events), SPEC, full, "full")
    assert amounts(table.read()) == amounts(full.read())


def test_a_first_load_reads_fields_not_whole_events(spark, folder, table):
    raw(spark, event(1, 100, 1, "a"), event(1, 101, 2, "b")).write.parquet(f"{folder}/raw")
    stream = spark.readStream.schema(RAW_SCHEMA).parquet(f"{folder}/raw")
    query = stream_entity(stream, SPEC, table, f"{folder}/ckpt", None)
    query.awaitTermination()
    # The reader's columns: a struct of the fields asked for instead of the variant.
    schema = query._jsq.explainInternal(True).rpartition("ReadSchema: ")[2].splitlines()[0]
    assert f"{CONTENT}:struct<" in schema and "variant" not in schema and amounts(table.read()) == {1: 2}


def test_a_first_load_in_parts_counts_late_events(spark, folder, table):
    parts = [[event(1, 100, 1, "a")], [event(2, 10, 2, "b"), event(3, None, 3, "c"), event(4, 99, 4, "d")]]
    for i, part in enumerate(parts):
        raw(spark, *part).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        for name in os.listdir(f"{folder}/raw"):
            if name.startswith("part-") and i == 0:
                os.utime(f"{folder}/raw/{name}", (1, 1))
    stream = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/raw")
    stream_entity(stream, SPEC, table, f"{folder}/ckpt", None).awaitTermination()
    counts = table.version().counts
    assert (counts["late_rows"], counts["untimed_rows"]) == (1, 1) and amounts(table.read()) == {1: 1, 4: 4}


def test_a_late_event_that_does_not_convert_stops_a_first_load_once(spark, folder, table):
    raw(spark, event(1, 100, 1, "a")).coalesce(1).write.parquet(f"{folder}/raw")
    for name in os.listdir(f"{folder}/raw"):
        if name.startswith("part-"):
            os.utime(f"{folder}/raw/{name}", (1, 1))
    raw(spark, event(2, 10, "much", "b")).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    stream = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/raw")
    with pytest.raises(PySparkException):
        stream_entity(stream, SPEC, table, f"{folder}/ckpt", None).awaitTermination()
    assert amounts(table.read()) == {1: 1}
    stream_entity(stream, SPEC, table, f"{folder}/ckpt", None).awaitTermination()
    assert table.version().counts["late_rows"] == 1 and amounts(table.read()) == {1: 1}


# Tables


def test_small_tables_become_events_on_all_cores(spark):
    inp, cores = Inputs(spark, "/root/testdata/sf0.001"), spark.sparkContext.defaultParallelism
    for name in ("customers", "products", "orders"):
        versions = inp.clean_versions(name)
        assert versions.rdd.getNumPartitions() >= cores and versions.count() == getattr(inp, name)().count()


def test_slices_are_picked_before_texts_are_made(spark):
    inp = Inputs(spark, "/root/testdata/sf0.001")
    raw, years = inp.entity_raw("payments", "payment"), (1998, 1999)
    part = inp.entity_raw("payments", "payment", years)
    ids = lambda df: sorted(r[0] for r in df.select("ce_id").collect())
    assert ids(part) == ids(raw.filter(F.year("ce_time").between(*years))) != ids(raw)
    days = (11, 20)
    clicks = inp.landing(days)
    assert ids(clicks) == ids(inp.landing().filter(F.dayofmonth("ce_time").between(*days)))
    for df, column in ((part, "l_shipdate"), (clicks, "ts")):
        # Below the text's generator: a plan's lower steps are printed later.
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan[plan.rindex(f"isnotnull({column}") :]


def _kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def _size(table):
    files, data = table._hadoop("data")
    return files.getContentSummary(data).getLength()


def test_a_small_merge_writes_its_batch_alone(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"], "t")
    rows_of = lambda ids, v: ids.select(
        F.col("id").alias("k"), F.lit(v).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("filler"),
        F.timestamp_seconds("id").alias("t"),
    )
    table.replace(rows_of(spark.range(0, 100_000, 1, 4), "old"))
    base, whole = table.version().base, _size(table)
    spread = spark.range(0, 100_000, 100).union(spark.range(200_000, 200_010))  # 1 % of the keys, and new ones
    table.merge(rows_of(spread, "new"))
    after = table.version()
    assert after.base == base and len(after.batches) == 1 and after.batch_rows == 1010
    assert _size(table) - whole < 0.05 * whole
    counted = {r["v"]: r["count"] for r in table.read().groupBy("v").count().collect()}
    assert counted == {"new": 1010, "old": 99_000}
    assert spark.range(1).select(table.newest()).first()[0] == datetime(1970, 1, 3, 7, 33, 29)
    # The base is not shuffled to put them together.
    plan = executed_plan(table.read())
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_batches_are_folded_and_many_put_together(spark, folder, rows, monkeypatch):
    monkeypatch.setattr(tables, "BATCHES", 3)
    for newest_by in (None, "v"):
        table = VersionedTable(spark, f"{folder}/{newest_by}", ["k"])
        want = {i: "0" for i in range(100)}
        table.replace(_kv(spark, *want.items()))
        seen = []
        for round_ in range(1, 9):
            batch = {i: str(round_) for i in range(round_, round_ + 2 + 30 * (round_ == 7))}
            want |= batch
            for _ in range(2):
                table.merge(_kv(spark, *batch.items()), newest_by)
                assert dict(rows(table.read())) == want
            seen.append((len(table.version().batches), table.version().base == seen[0][2] if seen else True, table.version().base))
        assert max(n for n, *_ in seen) <= 3
        assert [same for _, same, _ in seen] == [True] * 6 + [False] * 2
    # Batches that go together by another rule are folded first.
    table.merge(_kv(spark, (5, "00")))
    assert dict(rows(table.read())) == want | {5: "00"} and not table.version().batches


@pytest.mark.parametrize("newest_by", [None, "t"])
def test_a_large_batch_is_folded_in_one_pass(spark, folder, rows, monkeypatch, newest_by):
    written = []
    write = VersionedTable._write

    def spy(self, df, number):
        written.append(df)
        return write(self, df, number)

    monkeypatch.setattr(VersionedTable, "_write", spy)
    schema = "k long, v string, t timestamp"
    at = lambda day: datetime(2024, 1, day)
    table = VersionedTable(spark, folder, ["k"])
    table.replace(spark.createDataFrame([(1, "a", at(5)), (2, "b", None), (3, "c", at(5)), (None, "x", None), (None, "y", None)], schema))
    table.merge(spark.createDataFrame([(1, "old", at(1)), (2, "new", at(1)), (4, "d", None)], schema), newest_by)
    assert not table.version().batches
    first = "a" if newest_by else "old"
    assert rows(table.read(), "k", "v") == sorted(
        [(1, first), (2, "new"), (3, "c"), (4, "d"), (None, "x"), (None, "y")], key=repr
    )
    plan = written[-1]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_only_what_is_new_is_tested(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"])
    seen = []
    see = lambda df: seen.append(df.count())
    table.replace(_kv(spark, *[(i, "a") for i in range(100)]))
    table.merge(_kv(spark, (1, "b")), check=see)  # the base was never tested: once, with it
    table.merge(_kv(spark, (2, "b"), (100, "b")), check=see)
    assert seen == [1, 100, 2] and table.version().checked
    table.merge(_kv(spark, (3, "b")))
    table.merge(_kv(spark, (4, "b")), check=see)
    assert seen == [1, 100, 2, 1, 101]


def test_table_survives_a_run_that_dies(spark, folder, rows, monkeypatch):
    table = VersionedTable(spark, folder, ["k"])
    table.replace(_kv(spark, (1, "a")))
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(_kv(spark, (1, "b")))
    assert rows(table.read()) == [(1, "a")]
    table.merge(_kv(spark, (1, "c")))
    assert rows(table.read()) == [(1, "c")]


def test_table_refuses_missing_keys(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"])
    with pytest.raises(ValueError):
        table.merge(_kv(spark, (None, "x")))
    assert not table.exists()
    table.replace(_kv(spark, (1, "a")))
    with pytest.raises(ValueError):
        table.merge(_kv(spark, (None, "x")))
    assert rows(table.read()) == [(1, "a")]


def test_table_empty_batches_and_empty_tables(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"])
    table.replace(_kv(spark).limit(0))
    assert table.read().columns == ["k", "v"] and rows(table.read()) == []
    table.merge(_kv(spark, (1, "a")))
    table.merge(_kv(spark).limit(0))
    assert rows(table.read()) == [(1, "a")]


def test_commit_number_is_taken_once(spark, folder):
    table = VersionedTable(spark, folder)
    table.replace(_kv(spark, (1, "a")))
    with pytest.raises(PySparkException):
        table._commit(table.version())


def test_keys_belong_to_the_table(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"])
    table.replace(_kv(spark, *[(i, "old") for i in range(50)]))
    for other in (VersionedTable(spark, folder, ["v"]), VersionedTable(spark, folder)):
        with pytest.raises(ValueError):
            other.merge(_kv(spark, (1, "x")))
        with pytest.raises(ValueError):
            other.read()
    again = VersionedTable(spark, folder, ["k"])
    again.merge(_kv(spark, (1, "new"), (50, "new")))
    values = rows(VersionedTable(spark, folder, ["k"]).read())
    assert len(values) == len({k for k, _ in values}) == 51
    assert {k for k, v in values if v == "new"} == {1, 50}


def test_a_failed_check_leaves_the_old_version(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"])
    table.replace(_kv(spark, (1, "a")))

    def refuse(new):
        assert new.filter("v = 'b'").isEmpty()

    for change in (table.replace, table.merge):
        with pytest.raises(AssertionError):
            change(_kv(spark, (1, "b")), check=refuse)
        assert rows(table.read()) == [(1, "a")]
    table.merge(_kv(spark, (1, "c")), check=refuse)
    assert rows(table.read()) == [(1, "c")]


def test_newest_time_comes_from_the_commit(spark, folder):
    table = VersionedTable(spark, folder, ["k"], "t")

    def at(*seconds):
        rows = [(i, START + timedelta(seconds=s) if s is not None else None) for i, s in enumerate(seconds)]
        return spark.createDataFrame(rows, "k long, t timestamp")

    def newest():
        return spark.range(1).select(table.newest()).first()[0]

    assert table.newest() is None
    table.replace(at(5, 7, None))
    assert newest() == START + timedelta(seconds=7)
    table.merge(at(9))
    assert newest() == START + timedelta(seconds=9)
    # The row that held the newest time is replaced by an older one.
    table.merge(at(1))
    assert newest() == START + timedelta(seconds=7) == table.read().agg(F.max("t")).first()[0]


def test_clean_keeps_the_newest_versions(spark, folder, rows):
    table = VersionedTable(spark, folder, ["k"])
    table.replace(_kv(spark, *[(i, "0") for i in range(20)]))
    for round_ in "123":
        table.merge(_kv(spark, (1, round_)))
    table.clean(keep=2)
    assert table._commits() == [3, 4]
    files, data = table._hadoop("data/*")
    assert len(files.globStatus(data)) == 4  # the base and three batches
    table.replace(_kv(spark, *[(i, "0") for i in range(20)]))
    table.clean(keep=1)
    assert table._commits() == [5] and len(files.globStatus(data)) == 1
    table.merge(_kv(spark, (1, "4")))
    assert dict(rows(table.read()))[1] == "4"
