"""The given tables as inputs of the jobs, on Spark.

``oracles.py`` holds the same inputs as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.functions.events import CONTENT, with_computed
from silverbrook.operators.dedup import latest_per_key
from silverbrook.plans import marts
from silverbrook.schema import CLICK_EVENT_TYPE
from silverbrook.session import configure
from silverbrook.sources.raw_events import with_event_columns

CLICK_TYPES = ("view", "click", "purchase")
PREFIX = "com.example.shop"

# The grants of five sample users, and principals with their regions.
ENTITLEMENT_ROWS = """
  (1,'customer',2,'*'),(1,'store',2,'*'),(1,'product',2,'*'),(1,'order',2,'*'),
  (1,'order_item',2,'*'),(1,'payment',2,'*'),
  (2,'store',2,'*'),(2,'product',2,'*'),(2,'order',2,'*'),(2,'order_item',2,'*'),
  (3,'customer',1,'*'),(3,'order',2,'*'),(3,'order_item',2,'*'),
  (4,'store',2,'5'),(4,'product',2,'*'),(4,'order',2,'*'),(4,'order_item',2,'*'),
  (5,'payment',1,'*'),(5,'order',2,'*')"""
PRINCIPAL_ROWS = """
  ('ANALYST_EU','EUROPE','SALES',false,true),('ANALYST_NA','AMERICA','SALES',false,true),
  ('DATA_STEWARD','ALL','ALL',true,true),('EX_STEWARD','ALL','ALL',true,false)"""


class Inputs:
    """Lazily bound inputs of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table over all cores, for work on texts that costs more than moving its rows.

        Only a table with fewer splits than cores is moved, never a large one.
        """
        return self._spread(self.table(name))

    def _spread(self, df: DataFrame) -> DataFrame:
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

    # Staging tables -----------------------------------------------------

    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        )

    def stores(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("store_id"),
            F.col("n_name").alias("name"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state"),
            F.col("r_name").alias("country"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        )

    def orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % 25).alias("store_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(status == "F", "completed")
            .when(status == "O", "placed")
            .otherwise("shipped")
            .alias("status"),
        )

    def _lines(self) -> DataFrame:
        number = F.col("l_linenumber")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 8 + number).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            _payment_method(number).alias("payment_method"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
        )

    def lines_latest(self, *columns: str) -> DataFrame:
        order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        lines = self._lines().select("order_item_id", "l_shipdate", *order, *columns)
        latest = latest_per_key(lines, ["order_item_id"], "l_shipdate", "first", order)
        return latest.select("order_item_id", *columns)

    def order_items(self) -> DataFrame:
        return self.lines_latest("order_id", "product_id", "quantity")

    def payments(self) -> DataFrame:
        return self.lines_latest("order_id", "payment_method", "amount").withColumnRenamed(
            "order_item_id", "payment_id"
        )

    def marts(self, *names: str) -> dict[str, DataFrame]:
        """The marts by name, all of them unless some are named."""
        steps = {
            "dim_customers": lambda: marts.dim_customers(
                self.customers(), self.orders(), self.payments()
            ),
            "dim_products": lambda: marts.dim_products(self.products()),
            "dim_stores": lambda: marts.dim_stores(self.stores()),
            "dim_date": lambda: marts.dim_date_covering(self.orders(), "order_date"),
            "fact_orders": lambda: marts.fact_orders(self.orders(), self.payments()),
            "fact_order_items": lambda: marts.fact_order_items(self.order_items(), self.products()),
        }
        return {name: steps[name]() for name in names or steps}

    # Entitlements ---------------------------------------------------------

    def entitlements(self) -> DataFrame:
        """The sample users' grants, and one user per customer with grants on their own orders."""
        fixed = self.spark.sql(
            f"SELECT * FROM VALUES {ENTITLEMENT_ROWS} AS e(user_id, resource, access_level, object_id)"
        )
        own = self.table("orders").select(
            (F.col("o_custkey") + 100).alias("user_id"),
            F.lit("order").alias("resource"),
            (F.col("o_custkey") % 3).cast("int").alias("access_level"),
            F.col("o_orderkey").cast("string").alias("object_id"),
        )
        return fixed.unionByName(own)

    def many_grants(self) -> DataFrame:
        """One user with grants of three levels on every other order."""
        return self.table("orders").filter("o_orderkey % 2 = 0").select(
            F.lit(7).alias("user_id"),
            F.lit("order").alias("resource"),
            (F.col("o_custkey") % 3).cast("int").alias("access_level"),
            F.col("o_orderkey").cast("string").alias("object_id"),
        )

    def faulty_entitlements(self) -> DataFrame:
        """Grants with bad levels, missing resources and repeated keys."""
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("user_id"),
            F.when(F.col("l_returnflag") != "R", F.lit("order")).alias("resource"),
            (F.col("l_linenumber") % 5).alias("access_level"),
            F.col("l_orderkey").cast("string").alias("object_id"),
        )

    def principals(self) -> DataFrame:
        return self.spark.sql(
            f"SELECT * FROM VALUES {PRINCIPAL_ROWS} "
            "AS e(principal, region, department, pii_clearance, is_active)"
        )

    def customers_demo(self) -> DataFrame:
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        return (
            c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("full_name"),
                F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias(
                    "email"
                ),
                F.col("r_name").alias("region"),
            )
        )

    # Events ---------------------------------------------------------------

    def events(self) -> DataFrame:
        """The event table with an instant and the session number."""
        return self.spread("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )

    def event_texts(self, events: DataFrame | None = None) -> DataFrame:
        """Every event, or each of those given, as the text of an envelope."""
        kind, k = F.col("event_type"), F.col("k")
        data = F.struct(
            F.concat_ws("-", F.col("user_id"), k).alias("click_id"),
            k.alias("session_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % 2000).alias("product_id"),
            F.when(kind == "view", "home").when(kind == "click", "product").otherwise("cart").alias("page_type"),
            kind.alias("action"),
            F.element_at(F.array(*map(F.lit, ("mobile", "desktop", "tablet"))), (k % 3 + 1).cast("int")).alias(
                "device_type"
            ),
            F.when(k % 2 == 0, "organic").alias("referrer"),
            F.col("value"),
        )
        event_type = F.when(kind.isin(*CLICK_TYPES), F.lit(CLICK_EVENT_TYPE)).otherwise(
            F.concat(F.lit(f"{PREFIX}."), kind, F.lit(".upsert"))
        )
        envelope = _envelope(
            F.col("event_id").cast("string"),
            F.concat(F.lit("//shop/"), kind),
            event_type,
            F.col("ts"),
            data,
            F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("subject"),
        )
        events = self.events() if events is None else events
        return with_computed(events, "text", envelope).select("event_id", F.col("text").alias("value"))

    def faulty_texts(self) -> DataFrame:
        """The event texts with faults put into some, by the event's number."""
        text, fault = F.col("value"), F.col("event_id") % 20
        damaged = (
            F.when(fault == 0, F.replace(text, F.lit('"specversion":"1.0"'), F.lit('"specversion":"0.3"')))
            .when(fault == 1, F.regexp_replace(text, '"id":"[^"]*"', '"id":"   "'))
            .when(fault == 2, F.regexp_replace(text, '"source":"[^"]*"', r'"source":"\\t"'))
            .when(fault == 3, F.regexp_replace(text, '"id":"([^"]*)"', '"id":$1'))
            .when(fault == 4, F.regexp_replace(text, '"type":"[^"]*",', ""))
            .when(fault == 5, F.concat(F.lit("["), text, F.lit("]")))
            .when(fault == 6, F.concat(F.lit("not-json{"), text))
            .otherwise(text)
        )
        return self.event_texts().select("event_id", damaged.alias("value"))

    def raw_events(self, events: DataFrame | None = None) -> DataFrame:
        """All events, or those given, as rows of a raw table."""
        return _as_raw(self.event_texts(events))

    def landing(self, days: tuple[int, int] | None = None) -> DataFrame:
        """Click events as rows of the landing table, of some days of the month if they are given.

        An event's time is its row's: days are picked before texts are made of the rows.
        """
        events = None if days is None else self.events().filter(F.dayofmonth("ts").between(*days))
        return self.raw_events(events).filter(F.col("ce_type") == CLICK_EVENT_TYPE)

    # Raw events of the six entities ------------------------------------------

    def entity_versions(self, name: str) -> DataFrame:
        """Several versions of each entity as (event id, time, payload)."""
        line_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey")
        shipped = F.col("l_shipdate").cast("timestamp")
        if name == "customers":
            return self.spread("orders").select(
                F.col("o_orderkey").cast("string").alias("id"),
                F.col("o_orderdate").cast("timestamp").alias("time"),
                F.struct(
                    F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderpriority").alias("first_name"),
                    F.col("o_orderstatus").alias("last_name"),
                ).alias("data"),
            )
        if name == "stores":
            hours = F.make_dt_interval(hours=(F.col("c_custkey") % 1000).cast("int"))
            return self.spread("customer").select(
                F.col("c_custkey").cast("string").alias("id"),
                (F.lit("2024-01-01 00:00:00").cast("timestamp") + hours).alias("time"),
                F.struct(
                    F.col("c_nationkey").alias("store_id"),
                    F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("city"),
                    F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"),
                    F.col("c_mktsegment").alias("country"),
                ).alias("data"),
            )
        payload = {
            "products": F.struct(
                F.col("l_partkey").alias("product_id"),
                F.col("l_returnflag").alias("name"),
                F.col("l_linestatus").alias("category"),
                F.col("l_extendedprice").alias("price"),
            ),
            "orders": F.struct(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_suppkey").alias("customer_id"),
                F.col("l_linenumber").alias("store_id"),
                F.col("l_shipdate").cast("date").alias("order_date"),
                F.when(F.col("l_linestatus") == "F", "completed").otherwise("placed").alias("status"),
            ),
            "order_items": F.struct(
                (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_item_id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_quantity").cast("bigint").alias("quantity"),
            ),
            "payments": F.struct(
                (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("payment_id"),
                F.col("l_orderkey").alias("order_id"),
                _payment_method(F.col("l_linenumber")).alias("payment_method"),
                F.col("l_extendedprice").alias("amount"),
            ),
        }[name]
        return self.spread("lineitem").select(line_id.alias("id"), shipped.alias("time"), payload.alias("data"))

    def entity_texts(self, versions: DataFrame, entity: str) -> DataFrame:
        event_type = F.lit(f"{PREFIX}.{entity}.upsert")
        text = _envelope(F.col("id"), F.lit("//shop/test"), event_type, F.col("time"), F.col("data"))
        return versions.select(text.alias("value"))

    def entity_raw(self, name: str, entity: str, years: tuple[int, int] | None = None) -> DataFrame:
        """The raw table of one entity, of some years if they are given; they are picked before texts are made."""
        versions = self.entity_versions(name)
        if years is not None:
            versions = versions.filter(F.year("time").between(*years))
        return _as_raw(self.entity_texts(versions, entity))

    def clean_versions(self, name: str) -> DataFrame:
        """One event per row of a bound staging table, in the shape of ``entity_versions``."""
        if name in ("order_items", "payments"):
            return self.entity_versions(name)
        df, key = self._spread(getattr(self, name)()), name[:-1] + "_id"
        return df.select(
            F.col(key).cast("string").alias("id"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("time"),
            F.struct(*df.columns).alias("data"),
        )


def _payment_method(number: Column) -> Column:
    slot = number % 4
    return (
        F.when(slot == 0, "credit_card")
        .when(slot == 1, "coupon")
        .when(slot == 2, "bank_transfer")
        .otherwise("gift_card")
    )


def _envelope(
    event_id: Column, source: Column, event_type: Column, time: Column, data: Column, *extra: Column
) -> Column:
    return F.to_json(
        F.struct(
            F.lit("1.0").alias("specversion"),
            event_id.alias("id"),
            source.alias("source"),
            event_type.alias("type"),
            F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
            *extra,
            data.alias("data"),
        )
    )


def _as_raw(texts: DataFrame) -> DataFrame:
    parsed = with_computed(texts.select("value"), CONTENT, F.try_parse_json("value"))
    raw = parsed.select(
        F.lit(None).cast("timestamp").alias("ingested_at"),
        F.lit(None).cast("string").alias("source_file"),
        CONTENT,
    )
    return with_event_columns(raw)
