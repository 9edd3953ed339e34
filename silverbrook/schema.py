"""Declared columns of the staging tables and how declared types map to Spark."""

from __future__ import annotations

from dataclasses import dataclass

VARIANT = "variant"


@dataclass(frozen=True)
class Column:
    """A declared column; without ``data_type`` it stays a variant."""

    name: str
    data_type: str | None = None
    not_null: bool = False
    accepted: tuple[str, ...] = ()


@dataclass(frozen=True)
class EntitySpec:
    name: str
    event_entity: str
    keys: tuple[str, ...]
    columns: tuple[Column, ...]
    time_column: str = "ce_time"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


def spark_type(data_type: str | None, number_scale: int = 2) -> str:
    """Spark type of a declared type.

    ``number`` keeps cents by default; ``number_scale=0`` gives whole numbers
    of up to 38 digits instead.
    """
    if data_type is None:
        return VARIANT
    declared = data_type.strip().lower()
    if declared == "number":
        return "decimal(38,0)" if number_scale == 0 else f"decimal(18,{number_scale})"
    return {
        "integer": "bigint",
        "varchar": "string",
        "date": "date",
        "boolean": "boolean",
        "tinyint": "tinyint",
        "timestamp_tz": "timestamp",
        "timestamp_ltz": "timestamp",
        "variant": VARIANT,
    }.get(declared, declared)


# Value domains, entity names, keys and declared column types.
ORDER_STATUSES = ("placed", "shipped", "completed", "return_pending", "returned")
PAYMENT_METHODS = ("credit_card", "coupon", "bank_transfer", "gift_card")
PAGE_TYPES = ("home", "product", "cart", "checkout", "search", "category")
CLICK_ACTIONS = ("view", "click", "add_to_cart", "remove_from_cart", "checkout", "purchase")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
REFERRERS = ("organic", "direct", "paid_search", "email", "social", "affiliate")
CLICK_EVENT_TYPE = "ecommerce_clicks"
ROUTED_TYPES = (CLICK_EVENT_TYPE,)
RESOURCES = ("customer", "store", "product", "order", "order_item", "payment")

_CE_TIME = Column("ce_time", "timestamp_tz", not_null=True)

ENTITIES = {
    spec.name: spec
    for spec in (
        EntitySpec(
            "customers",
            "customer",
            ("customer_id",),
            (
                Column("customer_id", "integer", not_null=True),
                Column("first_name", "varchar", not_null=True),
                Column("last_name", "varchar", not_null=True),
                _CE_TIME,
            ),
        ),
        EntitySpec(
            "stores",
            "store",
            ("store_id",),
            (
                Column("store_id", "integer", not_null=True),
                Column("name", "varchar", not_null=True),
                Column("city", "varchar", not_null=True),
                Column("state", "varchar", not_null=True),
                Column("country", "varchar", not_null=True),
                _CE_TIME,
            ),
        ),
        EntitySpec(
            "products",
            "product",
            ("product_id",),
            (
                Column("product_id", "integer", not_null=True),
                Column("name", "varchar", not_null=True),
                Column("category", "varchar", not_null=True),
                Column("price", "number", not_null=True),
                _CE_TIME,
            ),
        ),
        EntitySpec(
            "orders",
            "order",
            ("order_id",),
            (
                Column("order_id", "integer", not_null=True),
                Column("customer_id", "integer", not_null=True),
                Column("store_id", "integer", not_null=True),
                Column("order_date", "date", not_null=True),
                Column("status", "varchar", accepted=ORDER_STATUSES),
                _CE_TIME,
            ),
        ),
        EntitySpec(
            "order_items",
            "order_item",
            ("order_item_id",),
            (
                Column("order_item_id", "integer", not_null=True),
                Column("order_id", "integer", not_null=True),
                Column("product_id", "integer", not_null=True),
                Column("quantity", "integer", not_null=True),
                _CE_TIME,
            ),
        ),
        EntitySpec(
            "payments",
            "payment",
            ("payment_id",),
            (
                Column("payment_id", "integer", not_null=True),
                Column("order_id", "integer", not_null=True),
                Column("payment_method", "varchar", accepted=PAYMENT_METHODS),
                Column("amount", "number", not_null=True),
                _CE_TIME,
            ),
        ),
    )
}

CLICK_COLUMNS = (
    Column("ce_id", "varchar", not_null=True),
    Column("ce_time", "timestamp_tz", not_null=True),
    Column("ce_source", "varchar"),
    Column("click_id", "varchar", not_null=True),
    Column("session_id", "integer"),
    Column("customer_id", "integer", not_null=True),
    Column("product_id", "integer", not_null=True),
    Column("page_type", "varchar", not_null=True, accepted=PAGE_TYPES),
    Column("action", "varchar", not_null=True, accepted=CLICK_ACTIONS),
    Column("device_type", "varchar", not_null=True, accepted=DEVICE_TYPES),
    Column("referrer", "varchar", accepted=REFERRERS),
)
