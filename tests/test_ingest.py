import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from silverbrook.functions.events import CONTENT
from silverbrook.operators.routing import judge_events, one_document, validate_events
from silverbrook.plans.build import FailedTests, build
from silverbrook.sources import event_store
from silverbrook.sources.event_store import write_event_store, write_quarantine
from silverbrook.sources.raw_events import (
    good_events,
    load_raw_incremental,
    load_report,
    read_bad_lines,
    read_raw_events,
    unloaded_events,
    unloaded_files,
)
from silverbrook.sources.tables import VersionedTable
from silverbrook.streaming.landing import forget_judged, read_batches, start_ingest, stream_event_store
from silverbrook.streaming.staging import (
    dropped_by_watermark,
    first_click_seen,
    missed_clicks,
    start_append,
    stream_clicks,
    stream_first_clicks,
)


def day():
    return F.lit(datetime(2024, 3, 9)).cast("timestamp")


def envelope(event_type, event_id="1", **data):
    return {
        "specversion": "1.0", "id": event_id, "source": "s", "type": event_type,
        "time": "2024-01-01T00:00:00Z", "data": data,
    }


def texts(spark, *events):
    return spark.createDataFrame([(json.dumps(e),) for e in events], "value string")


def store(spark, root, *events):
    valid, _ = validate_events(texts(spark, *events))
    write_event_store(valid, root, arrival=day())


def test_store_layout_and_scan(spark, folder, rows):
    store(spark, folder, envelope("a.b.upsert", "1"), envelope("a.b.delete", "2"), envelope("a.c.x", "3"), envelope("solo", "4"))
    scan = read_raw_events(spark, folder, "a.b")
    assert rows(scan, "ce_id") == [("1",), ("2",)]
    paths = {r[0] for r in scan.select("source_file").collect()}
    assert all("/entity=a.b/yyyy=2024/MM=03/dd=09/" in p for p in paths)
    assert rows(read_raw_events(spark, folder, ""), "ce_id") == [("4",)]


def test_stored_events_and_tables_are_compressed(spark, folder, rows, monkeypatch):
    monkeypatch.setitem(event_store.STORE_OPTIONS, "maxRecordsPerFile", "2")
    stored, _ = validate_events(texts(spark, *[envelope("a.b.upsert", str(i)) for i in range(5)]).coalesce(1))
    write_event_store(stored, f"{folder}/batch", arrival=day())
    stored.write.parquet(f"{folder}/valid")
    incoming = spark.readStream.schema(stored.schema).parquet(f"{folder}/valid")
    stream_event_store(incoming, f"{folder}/stream", f"{folder}/ckpt", None, day()).awaitTermination()
    for root in (f"{folder}/batch", f"{folder}/stream"):
        scan = read_raw_events(spark, root, "a.b")
        assert rows(scan, "ce_id") == [(str(i),) for i in range(5)]
        files = {r[0]: r[1] for r in scan.groupBy("source_file").count().collect()}
        assert all(name.endswith(".txt.gz") for name in files) and max(files.values()) <= 2
    assert all(name.endswith(".zstd.parquet") for name in os.listdir(f"{folder}/valid") if name.startswith("part-"))


def test_events_are_stored_as_they_came(spark, folder, rows):
    events = [envelope("a.b.upsert", str(i), n=[i, {"t": "} {"}]) for i in range(3)]
    came = [json.dumps(events[0]), json.dumps(events[1], separators=(",", ":")), json.dumps(events[2], indent=1)]
    valid, _ = validate_events(spark.createDataFrame([(t,) for t in came], "value string"))
    write_event_store(valid, folder, arrival=day(), text="value")
    stored = sorted(r[0] for r in spark.read.text(f"{folder}/entity=a.b").select("value").collect())
    # A text over several lines is made again as one.
    assert set(came[:2]) < set(stored) and [json.loads(s)["id"] for s in stored if s not in came] == ["2"]
    scan = read_raw_events(spark, folder, "a.b").select(F.to_json(CONTENT))
    assert sorted(rows(scan)) == sorted(rows(valid.select(F.to_json(CONTENT)))) and scan.count() == 3


def test_one_document_is_told(spark, rows):
    # With and without a closing bracket, which decides what has to be looked at.
    whole = ['{"a":1}', '{"a":[1]}', '{"a":"]"}', "1", "[1]", "null", ' "x"\n', '{"a":"} {"}']
    broken = [
        '{"a":1} x', '{"a":1}]', '{"a":1}],[2', '{"a":"]"} 1', "1 2", "1,2", "", " ", '{"a":1},{"b":2}', '{"a":1}}',
        '{"a":1}, "v":{', "[1] ]", '{"a":1}, "w":1', "[", "]", "1]", "1],[1", '{"a":1},', '{"a":1}]}',
    ]
    df = spark.createDataFrame([(t,) for t in whole + broken], "t string")
    assert rows(df.filter(one_document(F.col("t")).isNotNull()), "t") == sorted([(t,) for t in whole], key=repr)


def test_scan_skips_bad_lines_and_keeps_arrays_whole(spark, folder, rows):
    lines = ['{"id": "1"}', "broken{", "[1, 2]", ""]
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(f"{folder}/x")
    scan = read_raw_events(spark, folder, "", prefix=f"{folder}/x")
    assert rows(scan.select(F.to_json(CONTENT))) == [("[1,2]",), ('{"id":"1"}',)]


def test_text_after_a_value_is_a_bad_line(spark, folder, rows):
    root = f"{folder}/s"
    lines = ['{"id":"1"} junk', '{"id":"5"}[1]', '{"id":"2"} {"id":"3"}', "", "   ", '{"id":"4"', '{"id":"6"}']
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(f"{root}/entity=a")
    assert rows(read_raw_events(spark, root, "a"), "ce_id") == [("2",), ("3",), ("6",)]
    bad = [('{"id":"1"} junk',), ('{"id":"4"',), ('{"id":"5"}[1]',)]
    assert rows(read_bad_lines(spark, root, "a"), "bad_line") == bad
    load_raw_incremental(spark, root, "a", f"{folder}/raw", f"{folder}/ckpt").awaitTermination()
    table = spark.read.parquet(f"{folder}/raw")
    assert rows(good_events(table), "ce_id") == [("2",), ("3",), ("6",)]
    assert rows(load_report(table), "n_events", "n_bad_lines") == [(3, 3)]


def test_files_that_were_too_old_are_reported_and_readable(spark, folder, rows):
    root, table = f"{folder}/s", f"{folder}/raw"
    store(spark, root, envelope("a.x", "1"))
    load_raw_incremental(spark, root, "a", table, f"{folder}/ckpt").awaitTermination()
    old = f"{root}/entity=a/yyyy=2024/MM=03/dd=09/old.txt"
    with open(old, "w") as file:
        file.write(json.dumps(envelope("a.x", "old")) + "\n")
    os.utime(old, (0, 0))
    load_raw_incremental(spark, root, "a", table, f"{folder}/ckpt").awaitTermination()
    raw = spark.read.parquet(table)
    assert rows(raw, "ce_id") == [("1",)]
    assert [r.source_file.rsplit("/", 1)[1] for r in unloaded_files(spark, root, "a", raw).collect()] == ["old.txt"]
    assert rows(unloaded_events(spark, root, "a", raw), "ce_id") == [("old",)]


def test_lines_may_hold_several_objects(spark, folder, rows):
    values = [
        '{"a":"x}{y"}', '{"a":"\\\\"}', '{"a":"\\"} {\\""}', '{"a":{"b":[{"c":"}"},{"d":1}]}}',
        '{"a":"\\\\\\"}{"}', '{}',
    ]
    assert all(json.loads(v) is not None for v in values)
    lines = ["".join(values), " \t".join(values), values[0], '{"ok":1}{"bad":}{"ok":2}']
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(f"{folder}/x")
    scan = read_raw_events(spark, folder, "", prefix=f"{folder}/x")
    found = sorted(json.dumps(json.loads(r[0])) for r in scan.select(F.to_json(CONTENT)).collect())
    want = [*values, *values, values[0], '{"ok":1}', '{"ok":2}']
    assert found == sorted(json.dumps(json.loads(v)) for v in want)


def test_files_load_once(spark, folder):
    root, table, checkpoint = f"{folder}/s", f"{folder}/raw", f"{folder}/ckpt"

    def load():
        load_raw_incremental(spark, root, "a", table, checkpoint).awaitTermination()
        return spark.read.parquet(table).count()

    store(spark, root, envelope("a.x", "1"))
    assert [load(), load()] == [1, 1]
    store(spark, root, envelope("a.x", "2"), envelope("a.y", "1"))
    assert [load(), load()] == [3, 3]


def test_quarantine_folders(spark, folder, rows):
    _, rejected = validate_events(spark.createDataFrame([("x",), ("[]",), ("{}",)], "value string"))
    write_quarantine(rejected, folder, arrival=day())
    kept = spark.read.json(folder)
    found = rows(kept, "error_type", F.size("errors"), "raw")
    assert found == [
        ("invalid-JSON-body", 1, "x"),
        ("invalid-event", 4, "{}"),
        ("request-body-must-be-a-JSON-object", 1, "[]"),
    ]
    assert kept.select(F.input_file_name()).first()[0].endswith(".json.gz")


def test_ingest_restarts_without_losing_or_repeating(spark, folder):
    def run(*events):
        texts(spark, *events).coalesce(1).write.mode("append").text(f"{folder}/in")
        stream = spark.readStream.schema("value string").text(f"{folder}/in")
        for q in start_ingest(stream, folder, f"{folder}/ckpt", interval=None):
            q.awaitTermination()
        landing = spark.read.parquet(f"{folder}/landing")
        assert landing.filter("ingested_at is not null").count() == 0
        return landing.count(), spark.read.text(f"{folder}/events").count()

    click = envelope("ecommerce_clicks", "c")
    assert run(click, envelope("a.b", "1")) == (1, 1)
    assert run(click, {"id": 1}) == (2, 1)


def test_sinks_keep_up_with_an_interval(spark, folder):
    """The queries of a running ingest write at every interval, without being restarted."""
    def arrive(*events):
        texts(spark, *events).coalesce(1).write.mode("append").text(f"{folder}/in")

    arrive(envelope("ecommerce_clicks", "c"))
    stream = spark.readStream.schema("value string").text(f"{folder}/in")
    queries = start_ingest(stream, folder, f"{folder}/ckpt", interval="1 second")
    try:
        for count in (1, 2):
            if count == 2:
                arrive(envelope("ecommerce_clicks", "d"), envelope("a.b", "1"))
            for query in queries:  # the judging query first, then what reads from it
                query.processAllAvailable()
            assert spark.read.parquet(f"{folder}/landing").count() == count
        assert spark.read.text(f"{folder}/events").count() == 1
    finally:
        for query in queries:
            query.stop()


def _clicks(spark, path, *clicks):
    valid, _ = validate_events(texts(spark, *[envelope("ecommerce_clicks", i, click_id=c, page_type=p) for i, c, p in clicks]))
    landed = valid.select(CONTENT, F.lit(None).cast("timestamp").alias("ingested_at"))
    landed.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_clicks_stream_does_not_deduplicate(spark, folder):
    landed = _clicks(spark, f"{folder}/l", ("1", "a", "home"), ("2", "a", "cart"))
    stream_clicks(landed, f"{folder}/c", f"{folder}/k", None).awaitTermination()
    assert spark.read.parquet(f"{folder}/c").count() == 2


def test_first_click_across_batches(spark, folder, rows):
    _clicks(spark, f"{folder}/l", ("1", "a", "home"), ("2", "b", "home"))
    landed = _clicks(spark, f"{folder}/l", ("3", "a", "cart"), ("4", "a", "cart"), ("5", "c", "cart"))
    start_append(first_click_seen(landed, "15 seconds"), f"{folder}/c", f"{folder}/k", interval=None).awaitTermination()
    kept = spark.read.parquet(f"{folder}/c")
    assert rows(kept, "click_id", "page_type") == [("a", "home"), ("b", "home"), ("c", "cart")]


def test_late_clicks_are_counted_and_found(spark, folder, rows):
    def landed(event_id, second):
        e = {**envelope("ecommerce_clicks", event_id, click_id=event_id), "time": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}Z"}
        valid, _ = validate_events(texts(spark, e))
        part = valid.select(CONTENT, F.lit(None).cast("timestamp").alias("ingested_at"))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/l")
        stream = spark.readStream.schema(part.schema).parquet(f"{folder}/l")
        run = start_append(first_click_seen(stream, "15 seconds"), f"{folder}/c", f"{folder}/k", interval=None)
        run.awaitTermination()
        return dropped_by_watermark(run)

    assert [landed("a", 600), landed("b", 10), landed("c", 610)] == [0, 1, 0]
    kept = spark.read.parquet(f"{folder}/c")
    assert rows(kept, "click_id") == [("a",), ("c",)]


def test_late_clicks_are_kept_aside_in_the_stream(spark, folder, rows):
    table = VersionedTable(spark, f"{folder}/t", ["click_id", "ce_id"], "ce_time")

    def run(*events, restart=False):
        clicks = []
        for event_id, click, second in events:
            e = envelope("ecommerce_clicks", event_id, **({"click_id": click} if click else {}))
            clicks.append({**e, "time": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}Z"})
        valid, _ = validate_events(texts(spark, *clicks))
        part = valid.select(CONTENT, F.lit(None).cast("timestamp").alias("ingested_at"))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/l")
        stream = spark.readStream.schema(part.schema).parquet(f"{folder}/l")
        stream_first_clicks(stream, table, f"{folder}/late", f"{folder}/k", "15 seconds", None).awaitTermination()
        kept = table.read()
        late = read_batches(spark, f"{folder}/late", kept.schema)
        return rows(kept, "click_id", "ce_id"), rows(late, "ce_id"), rows(missed_clicks(late, kept), "click_id")

    assert run(("1", "a", 600), ("2", "a", 590), ("3", "b", 100)) == ([("a", "2"), ("b", "3")], [], [])
    # The watermark is 585 now: a click seen since is a repeat, an older one late, one without an id kept aside.
    kept, late, missed = run(("4", "a", 595), ("5", "c", 100), ("6", "a", 10), ("7", None, 610), ("8", "d", 610))
    assert (kept, late, missed) == ([("a", "2"), ("b", "3"), ("d", "8")], [("5",), ("6",), ("7",)], [("c",), (None,)])
    # Long after, a click is kept again.
    kept, late, _ = run(("9", "a", 2000), ("10", "e", 2000))
    assert kept == [("a", "2"), ("a", "9"), ("b", "3"), ("d", "8"), ("e", "10")] and len(late) == 3
    # A micro-batch that is repeated after its commit changes nothing.
    number = table.version().number
    for log in ("commits/2", "commits/.2.crc"):
        os.remove(f"{folder}/k/{log}")
    assert run(("11", "f", 2001))[0] == [*kept, ("f", "11")] and table.version().number == number + 1


def test_a_bad_batch_of_clicks_is_kept_out(spark, folder, rows):
    landing, warehouse = f"{folder}/l", f"{folder}/w"

    def run(*clicks):
        _clicks(spark, landing, *clicks)
        return build(spark, f"{folder}/none", warehouse, landing=landing).clicks

    def _clicks(spark, path, *clicks):
        full = [envelope("ecommerce_clicks", i, click_id=c, customer_id=1, session_id=1, product_id=1, page_type=p, action="view", page_url="u", device_type="mobile") for i, c, p in clicks]
        valid, _ = validate_events(texts(spark, *full))
        landed = valid.select(CONTENT, F.lit(None).cast("variant").alias("record_metadata"), F.lit(None).cast("timestamp").alias("ingested_at"))
        landed.coalesce(1).write.mode("append").parquet(path)

    assert rows(run(("1", "a", "home")), "click_id") == [("a",)]
    with pytest.raises(FailedTests, match="accepted_values"):
        run(("2", "b", "nowhere"), ("3", "c", "home"))
    kept = lambda name: spark.read.parquet(f"{warehouse}/{name}")
    assert rows(kept("clicks"), "click_id") == [("a",)]
    assert rows(kept("refused/clicks"), "click_id") == [("b",), ("c",)]
    # The next build is not stopped by it.
    assert rows(run(("4", "d", "home")), "click_id") == [("a",), ("d",)]


def test_days_that_all_sinks_have_passed_are_dropped(spark, folder):
    def arrive(*events):
        texts(spark, *events).coalesce(1).write.mode("append").text(f"{folder}/in")

    stream = lambda: spark.readStream.schema("value string").text(f"{folder}/in")
    for number in (1, 2, 3):
        arrive(envelope("ecommerce_clicks", str(number)), envelope("a.b", str(number)), {"id": number})
        arrival = F.lit(datetime(2024, 1, number)).cast("date")
        queries = start_ingest(stream(), folder, f"{folder}/k", interval="1 second", arrival=arrival)
        try:
            for query in queries:
                query.processAllAvailable()
            if number == 2:
                assert forget_judged(queries, spark, folder) == ["2024-01-01"]
                assert forget_judged(queries, spark, folder) == []
        finally:
            for query in queries:
                query.stop()
    assert sorted(n for n in os.listdir(f"{folder}/judged") if n.startswith("judged_on")) == ["judged_on=2024-01-02", "judged_on=2024-01-03"]
    # Sinks that start again after it lose and repeat nothing.
    assert spark.read.parquet(f"{folder}/landing").count() == 3
    assert spark.read.text(f"{folder}/events").count() == 3
    assert spark.read.schema("raw string").json(f"{folder}/quarantine").count() == 3


def test_events_are_parsed_once_for_all_sinks(spark):
    plan = judge_events(texts(spark, envelope("a.b")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_build_from_event_files(spark, folder):
    """Build, add events, build again; an entity without events gives an empty table."""
    prefix = "com.example.shop"

    def upsert(entity, event_id, second, **data):
        e = envelope(f"{prefix}.{entity}.upsert", event_id, **data)
        return {**e, "time": f"2024-01-01T00:00:{second:02d}Z"}

    order = {"order_id": 1, "customer_id": 1, "store_id": 5, "order_date": "2024-01-01", "status": "placed"}
    store(
        spark, f"{folder}/s",
        upsert("customer", "c1", 1, customer_id=1, first_name="A", last_name="B"),
        upsert("customer", "c2", 1, customer_id=2, first_name="C", last_name="D"),
        upsert("product", "p1", 1, product_id=1, name="tea", category="drink", price=3.5),
        upsert("order", "o1", 1, **order),
        upsert("payment", "y1", 1, payment_id=1, order_id=1, payment_method="coupon", amount=7.25),
        upsert("payment", "y2", 1, payment_id=2, order_id=1, payment_method="coupon", amount=1),
        upsert("order_item", "i1", 1, order_item_id=1, order_id=1, product_id=1, quantity=2),
        upsert("order_item", "i2", 1, order_item_id=2, order_id=1, product_id=99, quantity=2),
    )
    run = lambda **more: build(spark, f"{folder}/s", f"{folder}/w", **more)
    built = run()
    assert built.staging["stores"].count() == 0
    assert built.marts["dim_date"].count() == 3650
    customers = {r["customer_id"]: r for r in built.marts["dim_customers"].collect()}
    assert float(customers[1]["customer_lifetime_value"]) == 8.25
    assert customers[2]["number_of_orders"] is None
    items = {r["order_item_id"]: r["line_total"] for r in built.marts["fact_order_items"].collect()}
    assert float(items[1]) == 7 and items[2] is None

    store(spark, f"{folder}/s", upsert("order", "o2", 9, **{**order, "status": "shipped"}))
    assert [r["status"] for r in run().marts["fact_orders"].collect()] == ["shipped"]
    store(spark, f"{folder}/s", upsert("order", "o0", 2, **{**order, "order_id": 2}))
    assert {r["order_id"] for r in run(mode="full").marts["fact_orders"].collect()} == {1, 2}

    # A wrong path adds nothing and loses nothing.
    for mode in ("incremental", "full"):
        gone = build(spark, f"{folder}/nowhere", f"{folder}/w", mode)
        assert {r["order_id"] for r in gone.marts["fact_orders"].collect()} == {1, 2}
        assert gone.staging["products"].count() == 1

    store(spark, f"{folder}/s", upsert("order", "o3", 10, **{**order, "status": "lost"}))
    with pytest.raises(FailedTests, match="accepted_values"):
        run()
    # Readers still have the version before the failed test.
    orders = VersionedTable(spark, f"{folder}/w/staging/orders", ["order_id"])
    assert {r["status"] for r in orders.read().collect()} == {"placed", "shipped"}
    assert len(orders._commits()) <= 3
