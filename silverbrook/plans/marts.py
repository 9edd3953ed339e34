"""The star schema: dimensions and facts from the staging tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.functions.calendar import calendar_columns
from silverbrook.functions.masks import tag_columns
from silverbrook.operators.joins import left_join_one
from silverbrook.schema import PAYMENT_METHODS

# The calendar's first day and length, and the PII columns.
CALENDAR_START = date(2017, 1, 1)
CALENDAR_DAYS = 3650
CUSTOMER_PII = {
    "first_name": {"pii": True, "data_type": "varchar"},
    "last_name": {"pii": True, "data_type": "varchar"},
}


def customer_orders(orders: DataFrame) -> DataFrame:
    """First and latest order date and number of orders of each customer."""
    return orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("most_recent_order"),
        F.count("order_id").alias("number_of_orders"),
    )


def _paid_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("amount").alias("paid"))


def customer_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Total paid per customer; payments without an order fall in the NULL group.

    Payments are summed per order first, so the join sees one row per order
    however many payments one order has.
    """
    return (
        _paid_per_order(payments)
        .join(orders.select("order_id", "customer_id"), "order_id", "left")
        .groupBy("customer_id")
        .agg(F.sum("paid").alias("total_amount"))
    )


def dim_customers(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per customer with order and payment figures, NULL where there are none.

    Both summaries group orders by customer, so they are computed together:
    the orders are read and shuffled once, and payments without an order,
    which belong to no customer, drop out in the join.
    """
    summary = (
        orders.select("order_id", "customer_id", "order_date")
        .join(_paid_per_order(payments), "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("most_recent_order"),
            F.count("order_id").alias("number_of_orders"),
            F.sum("paid").alias("customer_lifetime_value"),
        )
    )
    joined = customers.select("customer_id", "first_name", "last_name").join(
        summary, "customer_id", "left"
    )
    return tag_columns(joined, CUSTOMER_PII)


def order_payments(payments: DataFrame, methods: Sequence[str] = PAYMENT_METHODS) -> DataFrame:
    """Paid amount per order and listed method, 0 where unused, and the total of all methods."""
    by_method = [
        F.sum(F.when(F.col("payment_method") == m, F.col("amount")).otherwise(0)).alias(
            f"{m}_amount"
        )
        for m in methods
    ]
    return payments.groupBy("order_id").agg(*by_method, F.sum("amount").alias("total_amount"))


def fact_orders(
    orders: DataFrame, payments: DataFrame, methods: Sequence[str] = PAYMENT_METHODS
) -> DataFrame:
    """One row per order with its payments by method, NULL where there are none."""
    return orders.join(order_payments(payments, methods), "order_id", "left").select(
        "order_id",
        "customer_id",
        "store_id",
        "order_date",
        "status",
        *[f"{m}_amount" for m in methods],
        F.col("total_amount").alias("amount"),
    )


def fact_order_items(
    order_items: DataFrame, products: DataFrame, salted: bool | None = None
) -> DataFrame:
    """One row per order item with the product's price at build time."""
    priced = left_join_one(
        order_items.select("order_item_id", "order_id", "product_id", "quantity"),
        products.select(F.col("product_id").alias("_product_id"), F.col("price").alias("unit_price")),
        "product_id",
        "_product_id",
        spread_by=["order_item_id"],
        salted=salted,
    )
    return priced.withColumn("line_total", F.col("quantity") * F.col("unit_price"))


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name", "category", "price")


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "name", "city", "state", "country")


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, days: int = CALENDAR_DAYS
) -> DataFrame:
    """One row per day from ``start`` with its calendar attributes."""
    spine = spark.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )
    return spine.select("date_day", *calendar_columns())


def dim_date_covering(df: DataFrame, date_col: str) -> DataFrame:
    """The calendar of all days between the first and the last date of a column."""
    ends = df.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))
    spine = ends.select(F.explode(F.sequence("first", "last")).alias("date_day"))
    return spine.select("date_day", *calendar_columns())
