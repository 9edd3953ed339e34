"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, IntegerType, TimestampType

from checks.bindings import PREFIX, Inputs
from silverbrook.functions.events import CONTENT, entity_key, envelope_columns, extract_typed
from silverbrook.functions.masks import mask_financial, mask_pii, tag_columns
from silverbrook.operators import quality, security
from silverbrook.operators.dedup import latest_per_key
from silverbrook.operators.incremental import lookback_filter, merge_upsert
from silverbrook.operators.routing import (
    QUARANTINE,
    TARGET,
    judge_events,
    route_events,
    validate_events,
)
from silverbrook.plans import marts, staging
from silverbrook.plans.as_user import query_as_user
from silverbrook.plans.build import build
from silverbrook.plans.materialize import materialize
from silverbrook.plans.secured import SECURED_VIEWS, secured_view
from silverbrook.plans.semantic import SHOP_MODEL, semantic_query
from silverbrook.schema import CLICK_COLUMNS, CLICK_EVENT_TYPE, ENTITIES, Column
from silverbrook.session import shared_dir
from silverbrook.sources.event_store import write_event_store, write_quarantine
from silverbrook.sources.raw_events import (
    RAW_SCHEMA,
    good_events,
    load_raw_incremental,
    load_report,
    read_raw_events,
)
from silverbrook.sources.tables import VersionedTable
from silverbrook.streaming import staging as streams
from silverbrook.streaming.landing import (
    JUDGED_ON,
    forget_judged,
    make_folder,
    read_batches,
    start_ingest,
    stream_event_store,
    stream_landing,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# The entities that events are stored under.
STORED = ("error", "signup")


def query(run: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function's name; its result gets comparable types.

    A ``run_`` in front keeps a function's name apart from the operator it runs.
    """
    name = run.__name__.removeprefix("run_")
    QUERIES[name] = lambda spark, sf_dir: plain(run(Inputs(spark, sf_dir)))
    return run


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as long, instants as microseconds: types that compare alike."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, TimestampType):
            column = F.unix_micros(column)
        out.append(column.alias(field.name))
    return df.select(*out)


# Ingestion ------------------------------------------------------------------


@query
def raw_event_scan(inp: Inputs) -> DataFrame:
    root = shared_dir(inp.spark, "store")
    _, stored = route_events(inp.raw_events())
    write_event_store(stored, root)
    scans = [read_raw_events(inp.spark, root, f"{PREFIX}.{name}") for name in STORED]
    raw = reduce(DataFrame.unionByName, scans)
    return raw.select("ce_id", "ce_type", "ce_time", _data("value", "double").alias("value"))


@query
def raw_load_once(inp: Inputs) -> DataFrame:
    """Load, load again, add files, load again: every event is there once."""
    base = shared_dir(inp.spark, "load")
    _, stored = route_events(inp.raw_events())
    stored.write.parquet(f"{base}/events")
    events = inp.spark.read.parquet(f"{base}/events")
    days = F.dayofmonth("ce_time")

    def load() -> None:
        for name in STORED:
            load_raw_incremental(
                inp.spark, f"{base}/store", f"{PREFIX}.{name}", f"{base}/raw-{name}", f"{base}/ckpt-{name}"
            ).awaitTermination()

    write_event_store(events.filter(days <= 15), f"{base}/store")
    load()
    load()
    write_event_store(events.filter(days > 15), f"{base}/store")
    load()
    loaded = [good_events(inp.spark.read.parquet(f"{base}/raw-{name}")) for name in STORED]
    return reduce(DataFrame.unionByName, loaded).groupBy("ce_id").agg(F.count("*").alias("times_loaded"))


@query
def bad_lines_report(inp: Inputs) -> DataFrame:
    """Every stored line with a fault by its number: junk after the value, a second value, broken text."""
    base = shared_dir(inp.spark, "lines")
    text, fault = F.col("value"), F.col("event_id") % 4
    line = (
        F.when(fault == 0, F.concat(text, F.lit(" junk")))
        .when(fault == 1, F.concat(text, F.lit("[1]")))
        .when(fault == 2, F.concat(text, F.lit(" "), text))
        .otherwise(F.substring(text, 1, 40))
    )
    inp.event_texts().select(line.alias("value")).write.text(f"{base}/store/entity=all")
    load_raw_incremental(inp.spark, f"{base}/store", "all", f"{base}/raw", f"{base}/ckpt").awaitTermination()
    report = load_report(inp.spark.read.parquet(f"{base}/raw"))
    return report.agg(F.sum("n_events").alias("n_events"), F.sum("n_bad_lines").alias("n_bad_lines"))


def _data(name: str, data_type: str):
    return F.try_variant_get(F.col(CONTENT), f"$.data.{name}", data_type)


@query
def event_validate_valid(inp: Inputs) -> DataFrame:
    valid, _ = validate_events(inp.faulty_texts())
    return valid.select("event_id", "ce_id", "ce_type", "ce_source", "ce_time")


@query
def event_validate_rejects(inp: Inputs) -> DataFrame:
    _, rejected = validate_events(inp.faulty_texts())
    return rejected.select("event_id", F.explode("errors").alias("e")).select(
        "event_id", F.coalesce("e.field", F.lit("-")).alias("field"), "e.message"
    )


@query
def event_route(inp: Inputs) -> DataFrame:
    judged = judge_events(inp.faulty_texts())
    return judged.filter(F.col(TARGET) != QUARANTINE).select("event_id", TARGET)


@query
def event_entity_key(inp: Inputs) -> DataFrame:
    raw = inp.raw_events()
    return raw.groupBy("ce_type", entity_key("ce_type").alias("entity")).agg(
        F.count("*").alias("n_events")
    )


@query
def event_store_roundtrip(inp: Inputs) -> DataFrame:
    root = shared_dir(inp.spark, "store")
    _, stored = route_events(inp.raw_events())
    write_event_store(stored, root, arrival=F.col("ce_time"), compact=True)
    lines = inp.spark.read.schema("value string, entity string, yyyy string, MM string, dd string").text(root)
    return lines.groupBy("entity", "yyyy", "MM", "dd").agg(F.count("*").alias("n_events"))


@query
def event_quarantine(inp: Inputs) -> DataFrame:
    root = shared_dir(inp.spark, "quarantine")
    _, rejected = validate_events(inp.faulty_texts())
    write_quarantine(rejected, root)
    kept = inp.spark.read.schema(
        "raw string, errors array<struct<field:string,message:string>>, error_type string"
    ).json(root)
    return kept.groupBy("error_type").agg(
        F.count("*").alias("n_records"), F.sum(F.size("errors")).alias("n_errors")
    )


def _text_stream(inp: Inputs, texts: DataFrame, base: str) -> DataFrame:
    texts.select("value").write.mode("append").text(f"{base}/incoming")
    return inp.spark.readStream.schema("value string").text(f"{base}/incoming")


@query
def run_stream_all_sinks(inp: Inputs) -> DataFrame:
    """Texts of two days through all three sinks; what reached each of them. The first day is then dropped."""
    base = shared_dir(inp.spark, "ingest")
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for day, part in (("2024-01-01", first), ("2024-01-02", ~first)):
        texts = _text_stream(inp, inp.faulty_texts().filter(F.coalesce(part, F.lit(False))), base)
        arrival = F.lit(day).cast("date")
        running = start_ingest(texts, base, f"{base}/checkpoints", interval=None, arrival=arrival)
        for each in running:
            each.awaitTermination()
    gone = forget_judged(running, inp.spark, f"{base}")
    files = inp.spark.read.format("binaryFile").load(f"{base}/judged/{JUDGED_ON}=*/*/*")
    left = files.select(F.regexp_extract("path", f"{JUDGED_ON}=([^/]*)", 1)).distinct().collect()
    if gone != ["2024-01-01"] or [r[0] for r in left] != ["2024-01-02"]:
        raise RuntimeError(f"days dropped: {gone}, left: {left}")
    landed = inp.spark.read.parquet(f"{base}/landing").select(
        F.lit("landing").alias("sink"), F.col("ingested_at").isNull().alias("untimed")
    )
    stored = inp.spark.read.text(f"{base}/events").select(
        F.lit("store").alias("sink"), F.lit(True).alias("untimed")
    )
    kept = inp.spark.read.schema("raw string").json(f"{base}/quarantine").select(
        F.lit("quarantine").alias("sink"), F.lit(True).alias("untimed")
    )
    return (
        landed.unionByName(stored)
        .unionByName(kept)
        .groupBy("sink", "untimed")
        .agg(F.count("*").alias("n_events"))
    )


@query
def run_stream_landing(inp: Inputs) -> DataFrame:
    base = shared_dir(inp.spark, "landing")
    valid, _ = validate_events(_text_stream(inp, inp.event_texts(), base))
    routed, _ = route_events(valid)
    stream_landing(routed, f"{base}/landing", f"{base}/ckpt", interval=None).awaitTermination()
    return inp.spark.read.parquet(f"{base}/landing").select(
        F.variant_get(F.col("record_metadata"), "$.id", "string").alias("ce_id"),
        _data("customer_id", "bigint").alias("customer_id"),
        F.col("ingested_at").isNull().alias("untimed"),
    )


@query
def run_stream_event_store(inp: Inputs) -> DataFrame:
    base = shared_dir(inp.spark, "events")
    valid, _ = validate_events(_text_stream(inp, inp.event_texts(), base))
    _, stored = route_events(valid)
    stream_event_store(stored, f"{base}/events", f"{base}/ckpt", interval=None).awaitTermination()
    return inp.spark.read.text(f"{base}/events").groupBy("entity").agg(F.count("*").alias("n_events"))


@query
def landing_delivery_check(inp: Inputs) -> DataFrame:
    landed = inp.raw_events()
    clicks = staging.clicks_projection(landed).withColumn("ce_type", F.lit(CLICK_EVENT_TYPE))
    checks = {"landing": landed, "staging": clicks}
    landing, staged = (
        quality.delivery_check(df, CLICK_EVENT_TYPE, "ce_type", "ce_time").withColumn("place", F.lit(place))
        for place, df in checks.items()
    )
    return landing.unionByName(staged)


# Typed extraction -----------------------------------------------------------


@query
def typed_extract(inp: Inputs) -> DataFrame:
    columns = (
        Column("ce_id", "varchar"),
        Column("ce_time", "timestamp_tz"),
        Column("click_id", "varchar"),
        Column("customer_id", "integer"),
        Column("value", "number"),
        Column("missing", "varchar"),
        Column("referrer"),
    )
    typed = extract_typed(inp.raw_events(), columns)
    return typed.withColumn("referrer", F.to_json("referrer"))


@query
def typed_extract_whole_numbers(inp: Inputs) -> DataFrame:
    columns = (Column("ce_id", "varchar"), Column("value", "number"))
    return extract_typed(inp.raw_events(), columns, number_scale=0)


@query
def envelope_extract(inp: Inputs) -> DataFrame:
    return inp.raw_events().select(*envelope_columns())


@query
def clicks_projection(inp: Inputs) -> DataFrame:
    return staging.clicks_projection(inp.raw_events()).drop("ingested_at")


@query
def clicks_dedup(inp: Inputs) -> DataFrame:
    return staging.clicks_dedup(staging.clicks_projection(inp.raw_events())).drop("ingested_at")


def _as_landing_arrives(
    inp: Inputs, base: str, run: Callable[[DataFrame], StreamingQuery], slices=((1, 10), (11, 20), (21, 31))
) -> list[StreamingQuery]:
    """Let the landing table grow slice of time by slice of time, and the stream catch up after each."""
    runs = []
    for days in slices:
        part = inp.landing(days).select(CONTENT, "ingested_at")
        part.write.mode("append").parquet(f"{base}/landing")
        runs.append(run(inp.spark.readStream.schema(part.schema).parquet(f"{base}/landing")))
        runs[-1].awaitTermination()
    return runs


@query
def run_clicks_projection_stream(inp: Inputs) -> DataFrame:
    base = shared_dir(inp.spark, "clicks")
    _as_landing_arrives(
        inp, base, lambda landed: streams.stream_clicks(landed, f"{base}/clicks", f"{base}/ckpt", interval=None)
    )
    return inp.spark.read.parquet(f"{base}/clicks").drop("ingested_at")


@query
def stream_cadence(inp: Inputs) -> DataFrame:
    """A click stream that runs every second while its input grows: clicks, and the trigger's turn that shows them."""
    base = shared_dir(inp.spark, "cadence")
    inp.landing().select(CONTENT, "ingested_at", "ce_time").write.parquet(f"{base}/all")
    landed = inp.spark.read.parquet(f"{base}/all")
    make_folder(inp.spark, f"{base}/landing")
    stream = streams.read_landing(inp.spark, f"{base}/landing", landed.drop("ce_time").schema)
    running = streams.stream_clicks(stream, f"{base}/clicks", f"{base}/ckpt", interval="1 second")
    shown = None
    try:
        for turn, (first, last) in enumerate(((1, 10), (11, 20), (21, 31)), 1):
            part = landed.filter(F.dayofmonth("ce_time").between(first, last)).drop("ce_time")
            part.write.mode("append").parquet(f"{base}/landing")
            running.processAllAvailable()
            # What readers see now, and did not see a turn ago.
            clicks = inp.spark.read.parquet(f"{base}/clicks").select("ce_id", "click_id")
            new = clicks if shown is None else clicks.join(shown, "ce_id", "left_anti")
            new.withColumn("turn", F.lit(turn)).select("ce_id", "click_id", "turn").write.mode("append").parquet(
                f"{base}/shown"
            )
            shown = inp.spark.read.parquet(f"{base}/shown").select("ce_id")
        turns = [p for p in running.recentProgress if p.numInputRows]
        if len(turns) < 3 or sum(p.numInputRows for p in turns) != landed.count() or not running.isActive:
            raise RuntimeError(f"turns with rows: {[p.numInputRows for p in turns]}")
    finally:
        running.stop()
    return inp.spark.read.parquet(f"{base}/shown")


@query
def run_clicks_dedup_stream(inp: Inputs) -> DataFrame:
    base = shared_dir(inp.spark, "clicks")
    table = VersionedTable(inp.spark, f"{base}/clicks", ["click_id"])
    _as_landing_arrives(
        inp, base, lambda landed: streams.stream_clicks_latest(landed, table, f"{base}/ckpt", interval=None)
    )
    return table.read().drop("ingested_at")


@query
def run_clicks_first_stream(inp: Inputs) -> DataFrame:
    """Clicks kept and the slice of time each is kept from: that of its first arrival."""
    base = shared_dir(inp.spark, "clicks")

    def run(landed: DataFrame) -> StreamingQuery:
        first = streams.first_click_seen(landed, "40 days")
        return streams.start_append(first, f"{base}/clicks", f"{base}/ckpt", interval=None)

    _as_landing_arrives(inp, base, run)
    kept = inp.spark.read.parquet(f"{base}/clicks")
    day = F.dayofmonth("ce_time")
    return kept.select("click_id", F.when(day <= 10, 1).when(day <= 20, 2).otherwise(3).alias("slice"))


@query
def clicks_missed_by_watermark(inp: Inputs) -> DataFrame:
    """With a watermark of 15 seconds and the middle of the month coming last: every click is kept or in the side table."""
    base = shared_dir(inp.spark, "clicks")
    table = VersionedTable(inp.spark, f"{base}/clicks", ["click_id", "ce_id"], "ce_time")

    def run(landed: DataFrame) -> StreamingQuery:
        return streams.stream_first_clicks(landed, table, f"{base}/late", f"{base}/ckpt", "15 seconds", None)

    _as_landing_arrives(inp, base, run, ((1, 10), (21, 31), (11, 20)))
    kept = table.read()
    missed = streams.missed_clicks(read_batches(inp.spark, f"{base}/late", kept.schema), kept)
    # A click that comes again long after is kept again.
    every = kept.select("click_id").distinct().unionByName(missed.select("click_id"))
    return every.groupBy("click_id").agg(F.count("*").alias("times"))


@query
def dim_products(inp: Inputs) -> DataFrame:
    return marts.dim_products(inp.products())


@query
def dim_stores(inp: Inputs) -> DataFrame:
    return marts.dim_stores(inp.stores())


# Deduplication, incremental loads, merges ---------------------------------------


@query
def run_latest_per_key(inp: Inputs) -> DataFrame:
    return latest_per_key(inp.events(), ["user_id"], "ts", tie_break=["event_id"])


@query
def latest_per_composite_key(inp: Inputs) -> DataFrame:
    lines = inp.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_partkey", "l_suppkey", "l_extendedprice",
    )
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def run_lookback_filter(inp: Inputs) -> DataFrame:
    events = inp.events()
    target = events.filter("event_type = 'error'")
    return lookback_filter(events, target, "ts", seconds=86400).select("event_id", "ts")


# Event types in the order they are merged: a later one replaces an earlier one.
MERGE_ORDER = ("view", "signup", "error", "click", "purchase")


def _per_click(inp: Inputs, event_type: str) -> DataFrame:
    events = inp.events().filter(F.col("event_type") == event_type)
    return latest_per_key(events, ["user_id", "k"], "ts", tie_break=["event_id"])


@query
def run_merge_upsert(inp: Inputs) -> DataFrame:
    batches = [_per_click(inp, event_type) for event_type in MERGE_ORDER]
    return reduce(lambda target, batch: merge_upsert(target, batch, ["user_id", "k"]), batches)


@query
def merge_upsert_table(inp: Inputs) -> DataFrame:
    """The same merges on a stored table, twice each, which changes nothing: large batches are folded, others kept aside."""
    table = VersionedTable(inp.spark, shared_dir(inp.spark, "merge"), ["user_id", "k"])
    table.replace(_per_click(inp, MERGE_ORDER[0]))
    for event_type in MERGE_ORDER[1:]:
        for _ in range(2):
            materialize(_per_click(inp, event_type), "clicks", "incremental", table)
    return table.read()


def _stage(name: str) -> Callable[[Inputs], DataFrame]:
    spec = ENTITIES[name]

    def run(inp: Inputs) -> DataFrame:
        raw = inp.entity_raw(name, spec.event_entity)
        return staging.staged(staging.latest_versions(raw, spec), spec)

    run.__name__ = f"stage_{name}"
    return run


for _name in ENTITIES:
    query(_stage(_name))


@query
def stage_incremental(inp: Inputs) -> DataFrame:
    """A first load of older events, then an incremental one over all of them, twice."""
    spec = ENTITIES["payments"]
    base = shared_dir(inp.spark, "staging")
    table = VersionedTable(inp.spark, f"{base}/payments", spec.keys, spec.time_column)
    inp.entity_raw("payments", "payment").write.parquet(f"{base}/raw")
    raw = inp.spark.read.parquet(f"{base}/raw")
    staging.stage_entity(raw.filter(F.col("ce_time") < F.lit(date(1998, 7, 1))), spec, table)
    staging.stage_entity(raw, spec, table)
    return staging.stage_entity(raw, spec, table)


def _stage_in_slices(inp: Inputs, years: Sequence[tuple[int, int]]) -> VersionedTable:
    """Raw payment events arriving slice by slice, merged as they do."""
    spec = ENTITIES["payments"]
    base = shared_dir(inp.spark, "staging")
    table = VersionedTable(inp.spark, f"{base}/payments", spec.keys, spec.time_column)
    for between in years:
        raw = inp.entity_raw("payments", "payment", between)
        raw.write.mode("append").parquet(f"{base}/raw")
        stream = inp.spark.readStream.schema(raw.schema).parquet(f"{base}/raw")
        streams.stream_entity(stream, spec, table, f"{base}/ckpt", interval=None).awaitTermination()
    return table


@query
def stage_stream(inp: Inputs) -> DataFrame:
    """Raw events arriving in time order."""
    table = _stage_in_slices(inp, ((1900, 1997), (1998, 1999), (2000, 2100)))
    return staging.staged(table.read(), ENTITIES["payments"])


@query
def late_rows_report(inp: Inputs) -> DataFrame:
    """Raw events of which the middle years come last: all of those are late, and counted."""
    table = _stage_in_slices(inp, ((1900, 1997), (2000, 2100), (1998, 1999)))
    versions = [table.version(n) for n in range(1, table.version().number + 1)]
    counts = [(v.number, v.counts.get("late_rows", 0), v.counts.get("untimed_rows", 0)) for v in versions]
    return inp.spark.createDataFrame(counts, "version long, late_rows long, untimed_rows long")


# Marts ------------------------------------------------------------------------


@query
def customer_orders(inp: Inputs) -> DataFrame:
    return marts.customer_orders(inp.orders())


@query
def customer_payments(inp: Inputs) -> DataFrame:
    return marts.customer_payments(inp.payments(), inp.orders())


@query
def dim_customers(inp: Inputs) -> DataFrame:
    return marts.dim_customers(inp.customers(), inp.orders(), inp.payments())


@query
def order_payments_pivot(inp: Inputs) -> DataFrame:
    return marts.order_payments(inp.payments())


@query
def fact_orders(inp: Inputs) -> DataFrame:
    return marts.fact_orders(inp.orders(), inp.payments())


@query
def fact_order_items(inp: Inputs) -> DataFrame:
    return marts.fact_order_items(inp.order_items(), inp.products())


@query
def fact_order_items_salted(inp: Inputs) -> DataFrame:
    """The same fact with hot products salted, as for a product table too large to broadcast."""
    return marts.fact_order_items(inp.order_items(), inp.products(), salted=True)


@query
def dim_date(inp: Inputs) -> DataFrame:
    return marts.dim_date_covering(inp.orders(), "order_date")


@query
def dim_date_generated(inp: Inputs) -> DataFrame:
    """The generated calendar, joined to the days of the given orders and events."""
    days = inp.orders().select(F.col("order_date").alias("day")).unionByName(
        inp.events().select(F.col("ts").cast("date").alias("day"))
    )
    counted = days.groupBy("day").agg(F.count("*").alias("n_rows"))
    calendar = marts.dim_date(inp.spark, date(1995, 1, 1), 11000)
    return calendar.join(counted, F.col("date_day") == F.col("day")).drop("day")


@query
def materialize_table(inp: Inputs) -> DataFrame:
    table = VersionedTable(inp.spark, shared_dir(inp.spark, "mart"))
    df = marts.fact_orders(inp.orders(), inp.payments())
    return materialize(df, "fact_orders", "table", table)


@query
def materialize_stream(inp: Inputs) -> DataFrame:
    base = shared_dir(inp.spark, "mart")
    inp.raw_events().write.parquet(f"{base}/raw")
    raw = inp.spark.readStream.schema(RAW_SCHEMA).parquet(f"{base}/raw")
    clicks = staging.clicks_projection(raw)
    materialize(
        clicks, "clicks", "stream", path=f"{base}/clicks", checkpoint=f"{base}/ckpt", interval=None
    ).awaitTermination()
    return inp.spark.read.parquet(f"{base}/clicks").drop("ingested_at")


@query
def materialize_view(inp: Inputs) -> DataFrame:
    materialize(marts.customer_orders(inp.orders()), "customer_orders_view", "view")
    return inp.spark.table("customer_orders_view")


def _built(inp: Inputs):
    """Event files of every entity, loaded, staged and modelled."""
    base = shared_dir(inp.spark, "build")

    def land() -> None:
        landed = inp.landing().select(CONTENT, F.lit(None).cast("variant").alias("record_metadata"), "ingested_at")
        landed.write.parquet(f"{base}/landing")

    # Clicks land beside the stored events, which share a folder and are written one entity after another.
    with ThreadPoolExecutor(1) as pool:
        landing = pool.submit(land)
        for name, spec in ENTITIES.items():
            texts = inp.entity_texts(inp.clean_versions(name), spec.event_entity)
            valid, _ = validate_events(texts)
            write_event_store(valid, f"{base}/events", text="value")
        landing.result()

    def run(events: str, **more):
        return build(
            inp.spark,
            f"{base}/{events}",
            f"{base}/warehouse",
            event_prefix=PREFIX,
            landing=f"{base}/landing",
            **more,
        )

    run("events")
    # The event store is gone: nothing is added, and nothing is lost.
    run("gone")
    return run("gone", mode="full")


@query
def build_fact_orders(inp: Inputs) -> DataFrame:
    return _built(inp).marts["fact_orders"]


@query
def build_clicks(inp: Inputs) -> DataFrame:
    return _built(inp).clicks.drop("ingested_at")


# Row and column security --------------------------------------------------------


@query
def row_access_wildcard(inp: Inputs) -> DataFrame:
    return security.row_access(inp.orders(), inp.entitlements(), 2, "order", "order_id")


@query
def row_access_scoped(inp: Inputs) -> DataFrame:
    return security.row_access(inp.orders(), inp.entitlements(), 101, "order", "order_id")


@query
def row_access_denied(inp: Inputs) -> DataFrame:
    return security.row_access(inp.orders(), inp.entitlements(), 103, "order", "order_id")


@query
def row_access_many(inp: Inputs) -> DataFrame:
    """A user with a grant on every other order: too many for a list of ids."""
    return security.row_access(inp.orders(), inp.many_grants(), 7, "order", "order_id")


def _level(inp: Inputs, user_id: int, resource: str) -> int:
    return security.resolve_access(inp.entitlements(), user_id).get(resource, security.Access()).level


@query
def run_mask_pii(inp: Inputs) -> DataFrame:
    return inp.customers().select(
        "customer_id",
        mask_pii("first_name", _level(inp, 3, "customer")).alias("name_for_3"),
        mask_pii("first_name", _level(inp, 2, "customer")).alias("name_for_2"),
    )


@query
def run_mask_financial(inp: Inputs) -> DataFrame:
    return inp.payments().select(
        "payment_id",
        mask_financial("amount", _level(inp, 1, "payment"), "decimal(18,2)").alias("amount_for_1"),
        mask_financial("amount", _level(inp, 5, "payment"), "decimal(18,2)").alias("amount_for_5"),
    )


@query
def apply_masks(inp: Inputs) -> DataFrame:
    tagged = tag_columns(
        marts.dim_customers(inp.customers(), inp.orders(), inp.payments()),
        {
            "first_name": {"resource": "customer", "data_type": "varchar"},
            "last_name": {"resource": "store", "data_type": "VARCHAR(16)"},
            "customer_lifetime_value": {"resource": "customer", "data_type": "number"},
            "number_of_orders": {"resource": "order", "data_type": "integer"},
        },
    )
    return security.apply_masks(tagged, security.resolve_access(inp.entitlements(), 3))


# The user each secured view is read as, chosen to show both filters and masks.
VIEW_USERS = {
    "sv_dim_customers": 3,
    "sv_fact_orders": 101,
    "sv_fact_order_items": 4,
    "sv_dim_products": 4,
    "sv_dim_stores": 4,
    "sv_dim_date": 5,
}


def _secured(name: str) -> Callable[[Inputs], DataFrame]:
    def run(inp: Inputs) -> DataFrame:
        marts_read = inp.marts(SECURED_VIEWS[name].mart)
        return secured_view(name, marts_read, inp.entitlements(), VIEW_USERS[name])

    run.__name__ = name
    return run


for _name in SECURED_VIEWS:
    query(_secured(_name))


@query
def role_mask(inp: Inputs) -> DataFrame:
    customers = marts.dim_customers(inp.customers(), inp.orders(), inp.payments())
    shown, hidden = (
        security.apply_role_masks(customers, role)
        .select("customer_id", "first_name", "last_name", "number_of_orders")
        .withColumn("role", F.lit(role))
        for role in ("ANALYST", "ANALYST_NO_PII")
    )
    return shown.unionByName(hidden)


@query
def region_access(inp: Inputs) -> DataFrame:
    return security.region_access(inp.customers_demo(), inp.principals(), "ANALYST_EU")


@query
def region_access_all(inp: Inputs) -> DataFrame:
    return security.region_access(inp.customers_demo(), inp.principals(), "DATA_STEWARD")


@query
def clearance_mask(inp: Inputs) -> DataFrame:
    parts = []
    for principal in ("DATA_STEWARD", "EX_STEWARD"):
        cleared = security.has_clearance(inp.principals(), principal)
        parts.append(
            inp.customers_demo().select(
                F.lit(principal).alias("principal"),
                "customer_id",
                security.mask_by_clearance("full_name", cleared),
                security.mask_by_clearance("email", cleared),
                "region",
            )
        )
    return parts[0].unionByName(parts[1])


@query
def active_entitlements(inp: Inputs) -> DataFrame:
    return security.active_entitlements(inp.entitlements())


@query
def entitlement_checks(inp: Inputs) -> DataFrame:
    return quality.check_entitlements(inp.faulty_entitlements())


@query
def run_query_as_user(inp: Inputs) -> DataFrame:
    def load(session: SparkSession):
        own = Inputs(session, inp.sf_dir)
        return own.marts("fact_orders", "dim_date"), own.entitlements()

    sql = """
        SELECT o.status, d.year, min(o.order_date) AS first_date, count(*) AS n_orders,
               sum(o.amount) AS revenue
        FROM sv_fact_orders o JOIN sv_dim_date d ON o.order_date = d.date_day
        GROUP BY o.status, d.year ORDER BY revenue DESC, o.status, d.year;
    """
    return query_as_user(inp.spark, sql, "3", load)


@query
def query_as_user_all_rows(inp: Inputs) -> DataFrame:
    """A question with as many rows as there are orders: none is cut."""

    def load(session: SparkSession):
        own = Inputs(session, inp.sf_dir)
        return own.marts("fact_orders"), own.entitlements()

    return query_as_user(inp.spark, "SELECT order_id, status, amount FROM sv_fact_orders", 3, load)


# Semantic model -------------------------------------------------------------------


def _marts_read(metrics, dims, where) -> list[str]:
    """The marts of the metrics' entities and of those on the way to the dimensions."""
    found = set()
    for base in {SHOP_MODEL.metric(m).entity for m in metrics}:
        found.add(base)
        for name in (*dims, *where):
            found |= {hop.target for hop in SHOP_MODEL.path(base, SHOP_MODEL.resolve(name).entity)}
    return [SHOP_MODEL.entity(name).mart for name in found]


def _ask(name: str, metrics, dims=(), user_id: int | None = None, **more) -> None:
    def run(inp: Inputs) -> DataFrame:
        read = inp.marts(*_marts_read(metrics, dims, more.get("where", ())))
        if user_id is None:
            bound = SHOP_MODEL.bind(read)
        else:
            bound = SHOP_MODEL.secured(read, inp.entitlements(), user_id)
        return semantic_query(bound, metrics, dims, **more)

    run.__name__ = name
    query(run)


AS_OF = date(1998, 6, 15)

_ask(
    "sem_totals",
    ["total_revenue", "order_count", "customer_count", "total_product_revenue", "total_units_sold"],
)
_ask("sem_order_count", ["order_count"], user_id=1)
_ask("sem_revenue_by_category", ["total_product_revenue"], ["category"], user_id=1)
_ask("sem_revenue_by_customer", ["total_revenue"], ["customers.customer_id", "last_name"], user_id=1)
_ask(
    "sem_top_customers",
    ["order_count"],
    ["buyers.customer_id"],
    user_id=1,
    order_by=[("order_count", "desc")],
    limit=5,
)
_ask(
    "sem_orders_by_store_top10",
    ["order_count"],
    ["stores.store_id", "stores.name"],
    user_id=2,
    order_by=[("order_count", "desc")],
    limit=10,
)
_ask("sem_units_by_quarter", ["total_units_sold"], ["year", "quarter"])
_ask("sem_orders_by_status", ["order_count", "total_revenue"], ["status"])
_ask(
    "sem_items_and_orders_by_state",
    ["total_revenue", "total_product_revenue", "total_units_sold", "order_count"],
    ["stores.state", "is_weekend", "status"],
)
_ask("sem_secured_user3", ["order_count"], ["customers.customer_id", "first_name"], user_id=3)
_ask(
    "sem_secured_user4",
    ["total_revenue"],
    ["stores.store_id"],
    user_id=4,
    where={"locations.store_id": lambda c: c == 5},
)
_ask(
    "sem_secured_user5",
    ["total_revenue"],
    user_id=5,
    where={
        "order_date": lambda c: (c >= F.trunc(F.lit(AS_OF), "month"))
        & (c <= F.last_day(F.lit(AS_OF)))
    },
)


# Data quality -----------------------------------------------------------------------


@query
def dq_unique(inp: Inputs) -> DataFrame:
    return quality.check_unique(inp._lines(), ["order_item_id"])


@query
def dq_not_null(inp: Inputs) -> DataFrame:
    facts = marts.fact_orders(inp.orders(), inp.payments())
    return quality.check_not_null(facts, facts.columns)


@query
def dq_accepted_values(inp: Inputs) -> DataFrame:
    actions = next(c.accepted for c in CLICK_COLUMNS if c.name == "action")
    return quality.check_accepted(inp.events(), "event_type", actions)


@query
def dq_clicks(inp: Inputs) -> DataFrame:
    """The declared tests of the click table, on clicks with faults by their event's number."""
    clicks = staging.clicks_projection(inp.raw_events())
    number = F.col("ce_id").cast("bigint")
    faulty = clicks.withColumns(
        {
            "page_type": F.when(number % 7 == 0, "nowhere").otherwise(F.col("page_type")),
            "customer_id": F.when(number % 11 != 0, F.col("customer_id")),
        }
    )
    return quality.run_column_tests(faulty, CLICK_COLUMNS)


@query
def dq_all_tests(inp: Inputs) -> DataFrame:
    spec = ENTITIES["payments"]
    lines = inp._lines().select(
        F.col("order_item_id").alias("payment_id"),
        "order_id",
        F.when(F.col("l_tax") > 0.05, "cash").otherwise(F.col("payment_method")).alias("payment_method"),
        F.when(F.col("l_discount") > 0.05, F.col("amount")).alias("amount"),
        F.col("l_shipdate").alias("ce_time"),
    )
    return quality.run_tests(lines, spec)
