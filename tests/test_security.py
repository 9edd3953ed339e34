from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverbrook.functions.masks import tag_columns
from silverbrook.operators import security
from silverbrook.plans.as_user import RefusedQuery, answer_as_user, check_user_id, query_as_user
from silverbrook.plans.secured import secured_view, secured_views
from silverbrook.plans.semantic import SHOP_MODEL, SemanticError, semantic_query

GRANTS = [
    (1, "order", 2, "*"), (2, "order", 1, "2"), (2, "order", 1, "03"), (3, "order", 1, "*"), (3, "order", 2, "7"),
    (4, "order", 0, "*"), (5, "order", 1, "1"), (5, "order", 0, "*"), (6, "customer", 1, "*"),
    *[(7, "order", 1, str(i)) for i in range(5)],
    *[(9, r, 2, "*") for r in ("order", "customer", "store", "product", "order_item")],
]


@pytest.fixture(scope="module")
def grants(spark):
    return spark.createDataFrame(GRANTS, "user_id long, resource string, access_level int, object_id string")


@pytest.fixture(scope="module")
def marts(spark):
    money = "amount decimal(18,2)"
    orders = spark.createDataFrame(
        [(1, 1, 5, date(2024, 1, 1), "placed", Decimal("1.50")), (2, 1, 5, date(2024, 1, 6), "placed", None),
         (3, None, 6, date(2024, 1, 6), None, Decimal("4.00"))],
        f"order_id long, customer_id long, store_id long, order_date date, status string, {money}",
    )
    for method in ("credit_card", "coupon", "bank_transfer", "gift_card"):
        orders = orders.withColumn(f"{method}_amount", F.col("amount"))
    return {
        "fact_orders": orders,
        "dim_customers": spark.createDataFrame(
            [(1, "Ada", "L", Decimal("1.50")), (2, "Bob", "M", None)],
            "customer_id long, first_name string, last_name string, customer_lifetime_value decimal(18,2)",
        ),
        "fact_order_items": spark.createDataFrame(
            [(1, 1, 1, 2, Decimal("2.00"), Decimal("4.00")), (2, 1, 9, 1, None, None), (3, 3, 1, 5, Decimal("2.00"), Decimal("10.00"))],
            "order_item_id long, order_id long, product_id long, quantity long, unit_price decimal(18,2), line_total decimal(20,2)",
        ),
        "dim_products": spark.createDataFrame([(1, "tea", "drink", Decimal("2.00"))], "product_id long, name string, category string, price decimal(18,2)"),
        "dim_stores": spark.createDataFrame([(5, "N", "C", "S", "X")], "store_id long, name string, city string, state string, country string"),
        "dim_date": spark.createDataFrame([(date(2024, 1, 1), 2024, False), (date(2024, 1, 6), 2024, True)], "date_day date, year int, is_weekend boolean"),
    }


def _ids(df):
    return sorted(r["order_id"] for r in df.collect())


@pytest.mark.parametrize(
    "user, ids",
    # The text "03" is not the text of the number 3.
    [(1, [1, 2, 3]), (2, [2]), (3, [1, 2, 3]), (4, []), (5, [1]), (6, []), (7, [1, 2, 3]), (77, []), (None, [])],
)
def test_row_access(marts, grants, user, ids):
    assert _ids(security.row_access(marts["fact_orders"], grants, user, "order", "order_id")) == ids


def test_row_access_by_join_when_ids_are_many(marts, grants, monkeypatch):
    monkeypatch.setattr(security, "LITERAL_IDS", 2)
    seen = security.row_access(marts["fact_orders"], grants, 7, "order", "order_id")
    assert "LeftSemi" in seen._jdf.queryExecution().optimizedPlan().toString()
    assert _ids(seen) == [1, 2, 3]


def test_row_access_on_text_and_date_keys(marts, grants, spark):
    orders = marts["fact_orders"]
    text = orders.withColumn("order_id", F.concat(F.lit("0"), "order_id"))
    assert _ids(security.row_access(text, grants, 2, "order", "order_id")) == ["03"]
    dated = spark.createDataFrame([(8, "order", 1, "2024-01-01")], grants.schema)
    assert _ids(security.row_access(orders, dated, 8, "order", "order_date")) == [1]


def test_filter_and_masks_reach_the_scan(marts, grants, folder, spark):
    marts["fact_orders"].write.parquet(f"{folder}/o")
    stored = {"fact_orders": spark.read.parquet(f"{folder}/o")}
    plan = secured_view("sv_fact_orders", stored, grants, 5)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_id,1)" in plan and "NestedLoop" not in plan
    assert "amount" not in plan.split("ReadSchema")[1]


def test_level_on_one_object_unmasks_everywhere(marts, grants):
    view = secured_view("sv_fact_orders", marts, grants, 3)
    assert {r["order_id"]: r["amount"] for r in view.collect()} == {1: Decimal("1.50"), 2: None, 3: Decimal("4.00")}
    low = secured_view("sv_fact_orders", marts, grants, 7).collect()
    assert {r["amount"] for r in low} == {None}


def test_masks_keep_types_and_follow_declared_type(marts, grants):
    view = secured_view("sv_dim_customers", marts, grants, 6)
    assert [f.dataType for f in view.schema] == [f.dataType for f in marts["dim_customers"].schema]
    assert [(r["first_name"], r["customer_lifetime_value"]) for r in view.collect()] == [("Ada", None), ("Bob", None)]
    tags = {"first_name": {"resource": "store", "data_type": "NVARCHAR(10)"}, "last_name": {"resource": "store"}}
    masked = security.apply_masks(tag_columns(marts["dim_customers"], tags), {}).first()
    assert (masked["first_name"], masked["last_name"]) == ("***", None)


def test_calendar_is_open_and_nothing_else_without_a_user(marts, grants):
    views = secured_views(marts, grants, None)
    assert {n: v.count() for n, v in views.items() if v.count()} == {"sv_dim_date": 2}


@pytest.mark.parametrize("role, shown", [("ANALYST_NO_PII", "***"), ("X_NO_PII_Y", "***"), ("ANALYST", "Ada"), (None, "Ada")])
def test_role_masks(marts, role, shown):
    tags = {"first_name": {"pii": True, "data_type": "varchar"}, "customer_lifetime_value": {"pii": True, "data_type": "number"}}
    row = security.apply_role_masks(tag_columns(marts["dim_customers"], tags), role).orderBy("customer_id").first()
    assert row["first_name"] == shown and row["last_name"] == "L"
    assert (row["customer_lifetime_value"] is None) == (shown == "***")


def test_principals(spark):
    people = spark.createDataFrame(
        [("EU", "EU", "S", False, True), ("ALL", "ALL", "S", True, True), ("OLD", "ALL", "S", True, False)],
        "principal string, region string, department string, pii_clearance boolean, is_active boolean",
    )
    df = spark.createDataFrame([(1, "EU"), (2, "NA"), (3, None)], "id int, region string")
    count = lambda p: security.region_access(df, people, p).count()
    assert [count(p) for p in ("EU", "ALL", "OLD", "?", None)] == [1, 3, 0, 0, 0]
    cleared = lambda p: security.has_clearance(people, p)
    assert [cleared(p) for p in ("EU", "ALL", "OLD", None)] == [False, True, False, False]


def test_grants_that_break_the_constraints_are_refused(spark, grants):
    for bad in ((20, "order", 3, "*"), (20, "order", None, "*"), (20, "order", 1, None)):
        table = grants.unionByName(spark.createDataFrame([bad], grants.schema))
        with pytest.raises(security.InvalidEntitlements):
            security.resolve_access(table, 20)
        assert security.resolve_access(table, 9)["order"].level == 2


# Running SQL as a user


@pytest.mark.parametrize("bad", [None, 0, -1, "x", "", [], "1.5"])
def test_user_ids(bad):
    with pytest.raises(ValueError):
        check_user_id(bad)
    assert check_user_id("3") == 3


@pytest.fixture
def load(folder, marts, grants):
    for name, df in {**marts, "grants": grants}.items():
        df.write.parquet(f"{folder}/{name}")

    def read(session):
        return {n: session.read.parquet(f"{folder}/{n}") for n in marts}, session.read.parquet(f"{folder}/grants")

    return read


@pytest.fixture
def ask(spark, load):
    return lambda sql, user=1, **more: query_as_user(spark, sql, user, load, **more)


def test_as_user_values(ask):
    out = ask("SELECT order_id, order_date, amount, timestamp '2024-01-01 01:02:03.5' AS t, timestamp_ntz '2024-01-01' AS n "
              "FROM sv_fact_orders ORDER BY order_id DESC;")  # fmt: skip
    last = out.collect()[-1]
    assert tuple(last) == (1, "2024-01-01", 1.5, datetime(2024, 1, 1, 1, 2, 3).isoformat() + ".500000+00:00", "2024-01-01T00:00:00")


def test_as_user_caps_rows(ask):
    many = "SELECT explode(sequence(1, 600)) AS i FROM sv_fact_orders"
    assert ask(many).count() == 1800
    newest = "SELECT order_id FROM sv_fact_orders ORDER BY order_id DESC -- newest"
    assert [r[0] for r in ask(newest, max_rows=2).collect()] == [3, 2]


def test_as_user_tells_of_cut_rows(spark, ask, load):
    cut, whole = (answer_as_user(spark, "SELECT * FROM sv_fact_orders", 1, load, n) for n in (2, 3))
    assert (cut.cut, cut.rows.count(), whole.cut, whole.rows.count()) == (True, 2, False, 3)


def test_as_user_refuses_what_reaches_beyond_the_views(ask):
    for sql in (
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT java_method('java.lang.System', 'getenv', 'PATH') FROM sv_fact_orders",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT * FROM sv_fact_orders WHERE status = reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT (SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM sv_dim_date LIMIT 1)",
        "SELECT * FROM sv_fact_orders WHERE order_id IN (SELECT id FROM range(10))",
        "SELECT * FROM range(1000000)",
        "SELECT * FROM explode(sequence(1, 1000000))",
        "SELECT explode(sequence(1, 1000000))",
        "SELECT explode(sequence(1, 1000000)) FROM (SELECT 1)",
        "SELECT explode(sequence(1, x)) FROM (VALUES (1000000)) v(x)",
        "SELECT t.i FROM (SELECT 1) LATERAL VIEW explode(sequence(1, 1000000)) t AS i",
        "SELECT current_user(), user(), session_user() FROM sv_fact_orders",
        "SELECT current_database(), current_catalog() FROM sv_fact_orders",
        "SELECT version() FROM sv_fact_orders",
        "SELECT input_file_name() FROM sv_fact_orders",
        "SELECT uuid(), rand(), spark_partition_id() FROM sv_fact_orders",
        "SELECT order_id FROM sv_fact_orders ORDER BY rand()",
        "WITH r AS (SELECT * FROM range(5)) SELECT * FROM r",
    ):
        with pytest.raises(RefusedQuery):
            ask(sql)
    fine = "WITH o AS (SELECT * FROM sv_fact_orders) SELECT count(*) FROM o WHERE order_id IN (SELECT order_id FROM o) OR EXISTS (SELECT 1 FROM (VALUES (1)) v(x) WHERE x = o.order_id)"
    assert ask(fine).first()[0] == 3


def test_as_user_reads_no_setting_and_no_environment(spark, ask, monkeypatch):
    monkeypatch.setenv("SECRET_OF_THE_HOST", "secret")
    spark.conf.set("spark.some.secret", "secret")
    for name in ("env:HOME", "env:SECRET_OF_THE_HOST", "system:user.dir", "system:java.home", "spark.some.secret", "spark.checkpoint.dir"):
        # Within quotes it stands for itself; elsewhere it is no SQL.
        assert ask(f"SELECT '${{{name}}}' AS said FROM sv_fact_orders").first().said == f"${{{name}}}"
        with pytest.raises(PySparkException):
            ask(f"SELECT ${{{name}}} FROM sv_fact_orders")
    spark.conf.unset("spark.some.secret")


def test_as_user_may_call_functions_of_their_rows(ask):
    fine = """
        SELECT upper(status) AS s, count(*) AS n, sum(amount) FILTER (WHERE order_id > 0) AS total,
          max(current_date()) >= date'2024-01-01' AS now, array_size(array()) AS none,
          max(transform(array(order_id), i -> i + 1)[0]) AS next, avg(nullif(amount, 0)) AS mean
        FROM sv_fact_orders WHERE status LIKE 'p%' OR status IN ('a', 'b') OR order_date < now()
        GROUP BY ALL ORDER BY 1 NULLS LAST"""
    assert ask(fine).count() > 0
    ranked = "SELECT * FROM (SELECT order_id, row_number() OVER (ORDER BY order_id) AS nth, rank() OVER (ORDER BY status) AS r, lag(order_id) OVER (ORDER BY order_id) AS before FROM sv_fact_orders) WHERE nth <= 2"
    assert ask(ranked).count() == 2
    grouped = "SELECT status, grouping(status) AS g, ceil(sum(amount)) AS c FROM sv_fact_orders GROUP BY ROLLUP (status)"
    assert ask(grouped).count() > 1


def test_as_user_sees_only_own_views(ask, spark, folder, marts):
    marts["fact_orders"].createOrReplaceTempView("secret_orders")
    for sql in (
        "SELECT * FROM secret_orders",
        f"SELECT * FROM parquet.`{folder}/fact_orders`",
        "SET spark.sql.runSQLOnFiles=true",
        "DROP VIEW sv_fact_orders",
        "CREATE TABLE t AS SELECT 1",
    ):
        with pytest.raises(PySparkException):
            ask(sql).collect()
    assert ask("SELECT * FROM sv_fact_orders", user=2).count() == 1


# Semantic model


def test_synonyms_and_ambiguous_names():
    assert SHOP_MODEL.resolve("Clients.first_name") == SHOP_MODEL.resolve("first_name")
    assert SHOP_MODEL.resolve("menu items.name").output == "products_name"
    assert SHOP_MODEL.resolve("line items.order_item_id").entity == "order_items"
    for bad in ("name", "nothing", "stores.category", "nobody.name"):
        with pytest.raises(SemanticError):
            SHOP_MODEL.resolve(bad)


@pytest.mark.parametrize("metric, dim", [("total_revenue", "category"), ("customer_count", "status"), ("order_count", "order_items.order_item_id")])
def test_no_metric_by_the_many_side(marts, metric, dim):
    with pytest.raises(SemanticError):
        semantic_query(SHOP_MODEL.bind(marts), [metric], [dim])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_metrics_of_two_entities_meet_on_null_dimensions(marts):
    found = semantic_query(SHOP_MODEL.bind(marts), ["order_count", "total_units_sold"], ["status", "is_weekend"])
    assert found.columns == ["orders_status", "dates_is_weekend", "order_count", "total_units_sold"]
    assert _rows(found) == _rows(found.sparkSession.createDataFrame(
        [(None, True, 1, 5), ("placed", False, 1, 3), ("placed", True, 1, None)], found.schema))


def test_missing_dimension_rows_keep_their_facts(marts):
    revenue = semantic_query(SHOP_MODEL.bind(marts), ["total_product_revenue"], ["category", "state"])
    assert _rows(revenue) == [("drink", "S", Decimal("4.00")), ("drink", None, Decimal("10.00")), (None, "S", None)]


def test_filters_may_ask_for_missing_rows(marts):
    bound = SHOP_MODEL.bind(marts)
    alone = semantic_query(bound, ["order_count"], where={"stores.store_id": lambda c: c.isNull()})
    assert _rows(alone) == [(1,)]
    none = semantic_query(bound, ["order_count", "total_revenue"], where={"stores.state": lambda c: c == "?"})
    assert _rows(none) == [(0, None)]


def test_counts_distinct_customers(marts):
    assert _rows(semantic_query(SHOP_MODEL.bind(marts), ["customer_count"], ["last_name"])) == [("L", 1), ("M", 1)]
    bound = SHOP_MODEL.bind(marts)
    assert _rows(semantic_query(bound, ["customer_count", "order_count"])) == [(2, 3)]


def test_secured_model_hides_rows_and_values(marts, grants):
    user7 = SHOP_MODEL.secured(marts, grants, 7)
    assert _rows(semantic_query(user7, ["order_count", "total_revenue"], ["first_name"])) == [(None, 3, None)]
    assert _rows(semantic_query(SHOP_MODEL.secured(marts, grants, None), ["order_count"])) == [(0,)]
    user9 = SHOP_MODEL.secured(marts, grants, 9)
    assert _rows(semantic_query(user9, ["total_revenue"], ["first_name"], order_by=[("total_revenue", "desc")], limit=1)) == [
        (None, Decimal("4.00"))
    ]


def test_entities_on_the_way_share_one_scan(marts, folder, spark):
    """Order items, orders and customers by a customer's name: each mart is read once, and the numbers stay."""
    stored = {}
    for name, df in marts.items():
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    metrics = ["total_units_sold", "order_count", "customer_count", "total_revenue"]
    both = semantic_query(SHOP_MODEL.bind(stored), metrics, ["last_name", "first_name"])
    plan = both._jdf.queryExecution().executedPlan().toString()
    for name in ("fact_orders", "fact_order_items", "dim_customers"):
        assert plan.count(f"{folder}/{name}]") == 1, name
    apart = {m: {tuple(r)[:2]: r[2] for r in semantic_query(SHOP_MODEL.bind(stored), [m], ["last_name", "first_name"]).collect()} for m in metrics}
    keys = {k for found in apart.values() for k in found}
    assert {tuple(r)[:2]: tuple(r)[2:] for r in both.collect()} == {k: tuple(apart[m].get(k) for m in metrics) for k in keys}
    where = {"orders.status": lambda c: c == "placed"}
    some = semantic_query(SHOP_MODEL.bind(stored), ["total_units_sold", "order_count"], ["status"], where=where)
    alone = [semantic_query(SHOP_MODEL.bind(stored), [m], ["status"], where=where).first()[1] for m in ("total_units_sold", "order_count")]
    assert _rows(some) == [("placed", *alone)]
