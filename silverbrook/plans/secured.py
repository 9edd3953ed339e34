"""Views of the marts that show a user the rows and columns they are entitled to."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from silverbrook.functions.masks import tag_columns
from silverbrook.operators.security import Access, apply_masks, resolve_access, row_access


@dataclass(frozen=True)
class SecuredView:
    """A mart, the resource that guards its rows, and its masked columns' declared types."""

    name: str
    mart: str
    resource: str | None = None
    pk: str | None = None
    masked: dict[str, str] = field(default_factory=dict)


# View names, guarding resources and masked columns.
SECURED_VIEWS = {
    view.name: view
    for view in (
        SecuredView(
            "sv_dim_customers",
            "dim_customers",
            "customer",
            "customer_id",
            {"first_name": "varchar", "last_name": "varchar", "customer_lifetime_value": "number"},
        ),
        SecuredView(
            "sv_fact_orders",
            "fact_orders",
            "order",
            "order_id",
            {
                "credit_card_amount": "number",
                "coupon_amount": "number",
                "bank_transfer_amount": "number",
                "gift_card_amount": "number",
                "amount": "number",
            },
        ),
        SecuredView(
            "sv_fact_order_items",
            "fact_order_items",
            "order_item",
            "order_item_id",
            {"unit_price": "number", "line_total": "number"},
        ),
        SecuredView("sv_dim_products", "dim_products", "product", "product_id", {"price": "number"}),
        SecuredView("sv_dim_stores", "dim_stores", "store", "store_id"),
        SecuredView("sv_dim_date", "dim_date"),
    )
}


def secured_view(
    name: str,
    marts: dict[str, DataFrame],
    entitlements: DataFrame,
    user_id: int | None,
    access: dict[str, Access] | None = None,
) -> DataFrame:
    """One secured view for one user; the calendar is open to everyone."""
    view = SECURED_VIEWS[name]
    df = marts[view.mart]
    if view.resource is None:
        return df
    if access is None:
        access = resolve_access(entitlements, user_id)
    visible = row_access(
        df, entitlements, user_id, view.resource, view.pk, access.get(view.resource, Access())
    )
    tags = {
        column: {"resource": view.resource, "data_type": data_type}
        for column, data_type in view.masked.items()
    }
    return apply_masks(tag_columns(visible, tags), access)


def secured_views(
    marts: dict[str, DataFrame], entitlements: DataFrame, user_id: int | None
) -> dict[str, DataFrame]:
    """All secured views whose marts are given; the user's rights are looked up once."""
    access = resolve_access(entitlements, user_id)
    return {
        name: secured_view(name, marts, entitlements, user_id, access)
        for name, view in SECURED_VIEWS.items()
        if view.mart in marts
    }
