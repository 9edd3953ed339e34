from datetime import date
from decimal import Decimal

import pytest

from silverbrook.operators.joins import SALTS, left_join_one
from silverbrook.operators.quality import (
    check_accepted,
    check_entitlements,
    check_not_null,
    check_unique,
    run_tests,
)
from silverbrook.plans import marts
from silverbrook.schema import ENTITIES
from tests.conftest import executed_plan


@pytest.fixture(scope="module")
def shop(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    money = Decimal
    return {
        "customers": df([(1, "A", "a"), (2, "B", "b")], "customer_id long, first_name string, last_name string"),
        "orders": df(
            [(10, 1, 5, date(2024, 1, 2), "placed"), (11, 1, 6, date(2024, 1, 1), "shipped"), (12, 9, 6, date(2024, 1, 3), "placed")],
            "order_id long, customer_id long, store_id long, order_date date, status string",
        ),
        "payments": df(
            [(1, 10, "coupon", money("2.50")), (2, 10, "cash", money("1.00")), (3, 99, "coupon", money("7.00"))],
            "payment_id long, order_id long, payment_method string, amount decimal(18,2)",
        ),
    }


def test_customer_without_orders_has_nulls(shop):
    found = {r["customer_id"]: r for r in marts.dim_customers(**shop).collect()}
    assert set(found) == {1, 2}
    assert tuple(found[2])[3:] == (None, None, None, None)
    assert found[1]["number_of_orders"] == 2 and found[1]["customer_lifetime_value"] == Decimal("3.50")
    assert found[1]["first_order"] == date(2024, 1, 1)


def test_orphan_payments_form_the_null_group(shop):
    totals = {r[0]: r[1] for r in marts.customer_payments(shop["payments"], shop["orders"]).collect()}
    assert totals == {1: Decimal("3.50"), None: Decimal("7.00")}


def test_unlisted_method_counts_in_the_total_only(shop):
    facts = {r["order_id"]: r for r in marts.fact_orders(shop["orders"], shop["payments"]).collect()}
    assert set(facts) == {10, 11, 12}
    assert facts[10]["coupon_amount"] == Decimal("2.50") and facts[10]["amount"] == Decimal("3.50")
    assert facts[10]["gift_card_amount"] == 0
    assert facts[11]["amount"] is None and facts[11]["coupon_amount"] is None


def test_other_payment_methods(shop):
    pivot = marts.order_payments(shop["payments"], ["cash"])
    assert pivot.columns == ["order_id", "cash_amount", "total_amount"]


def test_calendar(spark):
    days = marts.dim_date(spark)
    assert days.count() == 3650
    ends = days.orderBy("date_day").collect()
    assert (ends[0]["date_day"], ends[-1]["date_day"]) == (date(2017, 1, 1), date(2026, 12, 29))
    first = ends[0].asDict()
    first.pop("date_day")
    assert first == {
        "year": 2017, "quarter": 1, "month": 1, "month_name": "Jan", "week_of_year": 52,
        "day_of_month": 1, "day_of_week": 0, "day_name": "Sun", "is_weekend": True,
    }


@pytest.mark.parametrize("salted", [True, False, None])
def test_hot_keys_join_like_others(spark, salted):
    many = [(i, 1) for i in range(4000)] + [(5000 + i, i) for i in range(2, 50)] + [(6000 + i, None) for i in range(300)]
    left = spark.createDataFrame(many, "id long, k long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(1, 40)], "rk long, v string")
    joined = left_join_one(left, right, "k", "rk", ["id"], salted)
    assert joined.columns == ["id", "k", "v"]
    want = sorted((i, k, f"v{k}" if k is not None and k < 40 else None) for i, k in many)
    assert sorted(map(tuple, joined.collect())) == want


def test_salting_spreads_a_hot_key(spark):
    left = spark.range(6400).selectExpr("id", "1L AS k")
    right = spark.createDataFrame([(1, "v")], "rk long, v string")
    plan = left_join_one(left, right, "k", "rk", ["id"], salted=True)
    spread = left.selectExpr(f"pmod(xxhash64(id), {SALTS}) AS s").groupBy("s").count()
    assert spread.count() == SALTS and spread.selectExpr("max(count)").first()[0] < 1.2 * 6400 / SALTS
    assert plan.filter("v = 'v'").count() == 6400


def test_salted_copies_are_never_broadcast(spark):
    left = spark.range(100).selectExpr("id", "id % 3 AS k")
    right = spark.createDataFrame([(0, "zero"), (1, "one")], "rk long, name string")
    joined = left_join_one(left, right, "k", "rk", ["id"], salted=True)
    plan = executed_plan(joined)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert joined.count() == 100


@pytest.mark.parametrize("salted", [True, False])
def test_no_pass_counts_rows_before_a_join(spark, salted):
    left = spark.range(100).selectExpr("id", "id AS k")
    right = spark.range(10).selectExpr("id AS rk", "id AS v")
    plan = left_join_one(left, right, "k", "rk", ["id"], salted)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 1


def test_unique_ignores_nulls(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (1, 2)], "a int, b int")
    assert rows(check_unique(df, ["a", "b"])) == [(1, 1, 2)]


def test_not_null_and_accepted(spark, rows):
    df = spark.createDataFrame([("x", None), (None, None), ("z", None)], "a string, b string")
    assert rows(check_not_null(df, ["a", "b"])) == [("a", 1), ("b", 3)]
    assert rows(check_accepted(df, "a", ["x"])) == [("z", 1)]


def test_declared_tests_pass_on_clean_rows(spark):
    good = spark.createDataFrame(
        [(1, 1, "coupon", Decimal("1.00")), (2, 1, None, Decimal("1.00"))],
        "payment_id long, order_id long, payment_method string, amount decimal(18,2)",
    ).selectExpr("*", "timestamp '2024-01-01' AS ce_time")
    assert run_tests(good, ENTITIES["payments"]).count() == 0


def test_entitlement_constraints(spark, rows):
    df = spark.createDataFrame(
        [(1, "order", 2, "*"), (1, "order", 0, "*"), (2, None, 3, "1"), (3, "order", None, "1")],
        "user_id long, resource string, access_level int, object_id string",
    )
    assert rows(check_entitlements(df)) == [
        ("access_level", "3", 1), ("not_null", "access_level", 1),
        ("not_null", "resource", 1), ("primary_key", "1/order/*", 2),
    ]
