"""What each registered query must return, as SQL over the given tables."""

from __future__ import annotations

from checks.bindings import ENTITLEMENT_ROWS, PRINCIPAL_ROWS

# Fixed values, written out here so that a wrong one in the package shows.
PAYMENT_METHODS = ("credit_card", "coupon", "bank_transfer", "gift_card")
CLICK_ACTIONS = ("view", "click", "add_to_cart", "remove_from_cart", "checkout", "purchase")
ENTITY_COLUMNS = {
    "customers": ("customer_id", "first_name", "last_name", "ce_time"),
    "stores": ("store_id", "name", "city", "state", "country", "ce_time"),
    "products": ("product_id", "name", "category", "price", "ce_time"),
    "orders": ("order_id", "customer_id", "store_id", "order_date", "status", "ce_time"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity", "ce_time"),
    "payments": ("payment_id", "order_id", "payment_method", "amount", "ce_time"),
}

_METHOD = """CASE l_linenumber % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'coupon'
       WHEN 2 THEN 'bank_transfer' ELSE 'gift_card' END"""
_BY_METHOD = ", ".join(
    f"SUM(CASE WHEN payment_method = '{m}' THEN amount ELSE 0 END) AS {m}_amount"
    for m in PAYMENT_METHODS
)
_METHOD_AMOUNTS = ", ".join(f"CAST({m}_amount AS DOUBLE) AS {m}_amount" for m in PAYMENT_METHODS)
_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_suppkey)"
_ORDER_COLUMNS = "order_id, customer_id, store_id, order_date, status"

CTES = {
    "customers": """SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
        split_part(c_name, '#', 2) AS last_name FROM customer""",
    "stores": """SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS name, n_name AS city,
        concat('R', CAST(n_regionkey AS VARCHAR)) AS state, r_name AS country
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "products": """SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
        CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part""",
    "shop_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        o_orderkey % 25 AS store_id, CAST(o_orderdate AS DATE) AS order_date,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'placed' ELSE 'shipped' END AS status
        FROM orders""",
    "lines_latest": f"""SELECT * FROM (
        SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id,
          l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
          {_METHOD} AS payment_method, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
          ROW_NUMBER() OVER (PARTITION BY l_orderkey * 8 + l_linenumber
            ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
              l_extendedprice DESC, l_discount DESC, l_tax DESC) AS rn
        FROM lineitem) WHERE rn = 1""",
    "payments": "SELECT order_item_id AS payment_id, order_id, payment_method, amount FROM lines_latest",
    "order_payments": f"""SELECT order_id, {_BY_METHOD}, SUM(amount) AS total_amount
        FROM payments GROUP BY order_id""",
    "customer_orders": """SELECT customer_id, MIN(order_date) AS first_order,
        MAX(order_date) AS most_recent_order, COUNT(order_id) AS number_of_orders
        FROM shop_orders GROUP BY customer_id""",
    "customer_payments": """SELECT o.customer_id, SUM(p.amount) AS total_amount
        FROM payments p LEFT JOIN shop_orders o ON p.order_id = o.order_id GROUP BY o.customer_id""",
    "dim_customers": """SELECT c.customer_id, c.first_name, c.last_name, co.first_order,
        co.most_recent_order, co.number_of_orders, cp.total_amount AS customer_lifetime_value
        FROM customers c LEFT JOIN customer_orders co ON c.customer_id = co.customer_id
        LEFT JOIN customer_payments cp ON c.customer_id = cp.customer_id""",
    "fact_orders": f"""SELECT o.order_id, o.customer_id, o.store_id, o.order_date, o.status,
        {", ".join(f"p.{m}_amount" for m in PAYMENT_METHODS)}, p.total_amount AS amount
        FROM shop_orders o LEFT JOIN order_payments p ON o.order_id = p.order_id""",
    "fact_order_items": """SELECT i.order_item_id, i.order_id, i.product_id, i.quantity,
        p.price AS unit_price, i.quantity * p.price AS line_total
        FROM lines_latest i LEFT JOIN products p ON i.product_id = p.product_id""",
    "dim_date": """SELECT date_day, year(date_day) AS year, quarter(date_day) AS quarter,
        month(date_day) AS month, left(monthname(date_day), 3) AS month_name,
        weekofyear(date_day) AS week_of_year, day(date_day) AS day_of_month,
        dayofweek(date_day) AS day_of_week, left(dayname(date_day), 3) AS day_name,
        dayofweek(date_day) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(MIN(order_date)::TIMESTAMP, MAX(order_date)::TIMESTAMP,
          INTERVAL 1 DAY)) AS DATE) AS date_day FROM shop_orders)""",
    "ev": """SELECT event_id, CAST(event_id AS VARCHAR) AS ce_id, epoch_us(ts) AS us, ts, user_id,
        event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'ecommerce_clicks'
          ELSE concat('com.example.shop.', event_type, '.upsert') END AS ce_type,
        concat('//shop/', event_type) AS ce_source FROM events""",
    "clicks": """SELECT ce_id, us AS ce_time, ce_source,
        concat(CAST(user_id AS VARCHAR), '-', CAST(k AS VARCHAR)) AS click_id, k AS session_id,
        user_id AS customer_id, event_id % 2000 AS product_id,
        CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'product' ELSE 'cart' END AS page_type,
        event_type AS action,
        CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
        CASE WHEN k % 2 = 0 THEN 'organic' END AS referrer
        FROM ev WHERE ce_type = 'ecommerce_clicks'""",
    "clicks_latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY click_id ORDER BY ce_time DESC NULLS FIRST, ce_id DESC) AS rn FROM clicks) WHERE rn = 1""",
    "entitlements": f"""SELECT user_id, resource, access_level, object_id FROM (VALUES {ENTITLEMENT_ROWS})
        AS e(user_id, resource, access_level, object_id)
        UNION ALL SELECT o_custkey + 100, 'order', o_custkey % 3, CAST(o_orderkey AS VARCHAR) FROM orders""",
    "principals": f"""SELECT * FROM (VALUES {PRINCIPAL_ROWS})
        AS e(principal, region, department, pii_clearance, is_active)""",
    "customers_demo": """SELECT c_custkey AS customer_id, c_name AS full_name,
        concat('c', CAST(c_custkey AS VARCHAR), '@example.com') AS email, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "faulty_grants": """SELECT l_suppkey AS user_id,
        CASE WHEN l_returnflag <> 'R' THEN 'order' END AS resource, l_linenumber % 5 AS access_level,
        CAST(l_orderkey AS VARCHAR) AS object_id FROM lineitem""",
    # Versions of the six entities: key columns first, then the event id and time.
    "versions_customers": """SELECT o_custkey AS customer_id, o_orderpriority AS first_name,
        o_orderstatus AS last_name, CAST(o_orderkey AS VARCHAR) AS id, epoch_us(o_orderdate) AS ce_time
        FROM orders""",
    "versions_stores": """SELECT CAST(c_nationkey AS BIGINT) AS store_id, c_name AS name, c_mktsegment AS city,
        concat('S', CAST(c_nationkey AS VARCHAR)) AS state, c_mktsegment AS country,
        CAST(c_custkey AS VARCHAR) AS id,
        epoch_us(TIMESTAMP '2024-01-01' + to_hours(c_custkey % 1000)) AS ce_time FROM customer""",
    "versions_products": f"""SELECT l_partkey AS product_id, l_returnflag AS name,
        l_linestatus AS category, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
        {_LINE_ID} AS id, epoch_us(l_shipdate) AS ce_time FROM lineitem""",
    "versions_orders": f"""SELECT l_orderkey AS order_id, l_suppkey AS customer_id,
        CAST(l_linenumber AS BIGINT) AS store_id, CAST(l_shipdate AS DATE) AS order_date,
        CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'placed' END AS status,
        {_LINE_ID} AS id, epoch_us(l_shipdate) AS ce_time FROM lineitem""",
    "versions_order_items": f"""SELECT l_orderkey * 8 + l_linenumber AS order_item_id,
        l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
        {_LINE_ID} AS id, epoch_us(l_shipdate) AS ce_time FROM lineitem""",
    "versions_payments": f"""SELECT l_orderkey * 8 + l_linenumber AS payment_id,
        l_orderkey AS order_id, {_METHOD} AS payment_method,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
        {_LINE_ID} AS id, epoch_us(l_shipdate) AS ce_time FROM lineitem""",
}

_NEEDS = {
    "payments": ["lines_latest"],
    "order_payments": ["payments"],
    "customer_orders": ["shop_orders"],
    "customer_payments": ["payments", "shop_orders"],
    "dim_customers": ["customers", "customer_orders", "customer_payments"],
    "fact_orders": ["shop_orders", "order_payments"],
    "fact_order_items": ["lines_latest", "products"],
    "dim_date": ["shop_orders"],
    "clicks": ["ev"],
    "clicks_latest": ["clicks"],
}


def _sql(body: str, *needs: str, **extra: str) -> str:
    """A query with the inputs it needs, and theirs, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _latest(name: str, source: str, where: str = "TRUE") -> str:
    """The newest version of each key, ties by event id and then by every column."""
    key, *others = ENTITY_COLUMNS[name]
    rest = [c for c in others if c != "ce_time"]
    order = ", ".join(
        ["ce_time DESC NULLS FIRST", "id DESC NULLS LAST", *[f"{c} DESC NULLS LAST" for c in rest]]
    )
    return f"""SELECT {", ".join(ENTITY_COLUMNS[name])} FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY {key} ORDER BY {order}) AS rn FROM {source} WHERE {where})
        WHERE rn = 1"""


def _as_doubles(name: str) -> str:
    money = {"products": "price", "payments": "amount"}.get(name)
    columns = ENTITY_COLUMNS[name]
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == money else c for c in columns)


def _stage(name: str) -> str:
    source = f"versions_{name}"
    return _sql(f"SELECT {_as_doubles(name)} FROM staged", source, staged=_latest(name, source))


_FACT_ORDERS = f"SELECT {_ORDER_COLUMNS}, {_METHOD_AMOUNTS}, CAST(amount AS DOUBLE) AS amount FROM fact_orders"
_ITEMS = """SELECT order_item_id, order_id, product_id, quantity,
    CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total FROM fact_order_items"""
_CLICKS_ALL = "SELECT * FROM clicks"
_PAYMENTS = f"SELECT {_as_doubles('payments')} FROM"
_VALID = "event_id % 20 > 6"


def _faults() -> str:
    def error(field: str, message: str, fault: int) -> str:
        text = message.replace("'", "''")
        return f"SELECT event_id, '{field}' AS field, '{text}' AS message FROM events WHERE event_id % 20 = {fault}"

    return " UNION ALL ".join(
        [
            error("specversion", "Value error, unsupported specversion: '0.3' — expected '1.0'", 0),
            error("id", "Value error, 'id' must be a non-empty string", 1),
            error("source", "Value error, 'source' must be a non-empty string", 2),
            error("id", "Input should be a valid string", 3),
            error("type", "Field required", 4),
            error("-", "request body must be a JSON object", 5),
            error("-", "invalid JSON body", 6),
        ]
    )


def _level(user: int, resource: str) -> str:
    """The highest level of a user on a resource, 0 without any grant."""
    return f"""(SELECT coalesce(MAX(access_level), 0) FROM entitlements
        WHERE user_id = {user} AND resource = '{resource}')"""


def _visible(user: int, resource: str, key: str, grants: str = "entitlements") -> str:
    """Whether a grant above level 0 names the row or all rows."""
    return f"""EXISTS (SELECT 1 FROM {grants} g WHERE g.user_id = {user} AND g.resource = '{resource}'
        AND g.access_level > 0 AND (g.object_id = '*' OR g.object_id = CAST({key} AS VARCHAR)))"""


def _text(column: str, user: int, resource: str) -> str:
    return f"CASE WHEN {_level(user, resource)} >= 1 THEN {column} ELSE '***' END"


def _amount(column: str, user: int, resource: str, kind: str = "DOUBLE") -> str:
    return f"CASE WHEN {_level(user, resource)} >= 2 THEN CAST({column} AS {kind}) END"


_AMOUNTS = (*[f"{m}_amount" for m in PAYMENT_METHODS], "amount")

_JOINED_ORDERS = """FROM fact_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
    LEFT JOIN stores s ON o.store_id = s.store_id LEFT JOIN dim_date d ON o.order_date = d.date_day"""
_JOINED_ITEMS = """FROM fact_order_items i LEFT JOIN fact_orders o ON i.order_id = o.order_id
    LEFT JOIN products p ON i.product_id = p.product_id
    LEFT JOIN stores s ON o.store_id = s.store_id LEFT JOIN dim_date d ON o.order_date = d.date_day"""
_STAR = ("fact_orders", "dim_customers", "stores", "dim_date")

ORACLES = {
    # Ingestion
    "raw_event_scan": _sql(
        "SELECT ce_id, ce_type, us AS ce_time, value FROM ev WHERE ce_type <> 'ecommerce_clicks'", "ev"
    ),
    "raw_load_once": _sql(
        "SELECT ce_id, CAST(1 AS BIGINT) AS times_loaded FROM ev WHERE ce_type <> 'ecommerce_clicks'", "ev"
    ),
    # By the event's number: junk, a second value, the event twice, broken text.
    "bad_lines_report": """SELECT COUNT(*) FILTER (WHERE event_id % 4 = 2) * 2 AS n_events,
        COUNT(*) FILTER (WHERE event_id % 4 <> 2) AS n_bad_lines FROM events""",
    "event_validate_valid": _sql(
        f"SELECT event_id, ce_id, ce_type, ce_source, us AS ce_time FROM ev WHERE {_VALID}", "ev"
    ),
    "event_validate_rejects": _faults(),
    "event_route": _sql(
        f"""SELECT event_id, CASE WHEN ce_type = 'ecommerce_clicks' THEN 'landing' ELSE 'store' END AS target
        FROM ev WHERE {_VALID}""",
        "ev",
    ),
    "event_entity_key": _sql(
        r"""SELECT ce_type, regexp_replace(ce_type, '(^|\.)[^.]*$', '') AS entity, COUNT(*) AS n_events
        FROM ev GROUP BY ALL""",
        "ev",
    ),
    "event_store_roundtrip": _sql(
        """SELECT concat('com.example.shop.', event_type) AS entity, strftime(ts, '%Y') AS yyyy,
        strftime(ts, '%m') AS "MM", strftime(ts, '%d') AS dd, COUNT(*) AS n_events
        FROM ev WHERE ce_type <> 'ecommerce_clicks' GROUP BY ALL""",
        "ev",
    ),
    "event_quarantine": """SELECT CASE event_id % 20 WHEN 5 THEN 'request-body-must-be-a-JSON-object'
        WHEN 6 THEN 'invalid-JSON-body' ELSE 'invalid-event' END AS error_type,
        COUNT(*) AS n_records, COUNT(*) AS n_errors FROM events WHERE event_id % 20 <= 6 GROUP BY ALL""",
    "stream_all_sinks": _sql(
        f"""SELECT CASE WHEN NOT ({_VALID}) THEN 'quarantine'
        WHEN ce_type = 'ecommerce_clicks' THEN 'landing' ELSE 'store' END AS sink,
        TRUE AS untimed, COUNT(*) AS n_events FROM ev GROUP BY ALL""",
        "ev",
    ),
    "stream_landing": _sql("SELECT ce_id, customer_id, TRUE AS untimed FROM clicks", "clicks"),
    "stream_event_store": _sql(
        """SELECT concat('com.example.shop.', event_type) AS entity, COUNT(*) AS n_events
        FROM ev WHERE ce_type <> 'ecommerce_clicks' GROUP BY ALL""",
        "ev",
    ),
    "landing_delivery_check": _sql(
        """SELECT place, COUNT(*) AS row_count, MAX(ce_time) AS latest
        FROM clicks, (VALUES ('landing'), ('staging')) AS p(place) GROUP BY place""",
        "clicks",
    ),
    # Typed extraction
    "typed_extract": _sql(
        """SELECT ce_id, us AS ce_time, concat(CAST(user_id AS VARCHAR), '-', CAST(k AS VARCHAR)) AS click_id,
        user_id AS customer_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
        CAST(NULL AS VARCHAR) AS missing, CASE WHEN k % 2 = 0 THEN '"organic"' END AS referrer FROM ev""",
        "ev",
    ),
    "typed_extract_whole_numbers": _sql(
        "SELECT ce_id, CAST(CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,0)) AS DOUBLE) AS value FROM ev",
        "ev",
    ),
    "envelope_extract": _sql(
        """SELECT ce_id, ce_type, ce_source, '1.0' AS ce_specversion, us AS ce_time,
        concat('user/', CAST(user_id AS VARCHAR)) AS ce_subject FROM ev""",
        "ev",
    ),
    "clicks_projection": _sql(_CLICKS_ALL, "clicks"),
    "clicks_dedup": _sql("SELECT * FROM clicks_latest", "clicks_latest"),
    "materialize_stream": _sql(_CLICKS_ALL, "clicks"),
    "clicks_projection_stream": _sql(_CLICKS_ALL, "clicks"),
    "clicks_dedup_stream": _sql("SELECT * FROM clicks_latest", "clicks_latest"),
    "stream_cadence": _sql(
        """SELECT ce_id, click_id, CAST(CASE WHEN day(make_timestamp(ce_time)) <= 10 THEN 1
          WHEN day(make_timestamp(ce_time)) <= 20 THEN 2 ELSE 3 END AS BIGINT) AS turn FROM clicks""",
        "clicks",
    ),
    "clicks_first_stream": _sql(
        """SELECT click_id, MIN(CASE WHEN day(make_timestamp(ce_time)) <= 10 THEN 1
          WHEN day(make_timestamp(ce_time)) <= 20 THEN 2 ELSE 3 END)::BIGINT AS slice
        FROM clicks GROUP BY click_id""",
        "clicks",
    ),
    "clicks_missed_by_watermark": _sql(
        "SELECT DISTINCT click_id, CAST(1 AS BIGINT) AS times FROM clicks", "clicks"
    ),
    "build_clicks": _sql(_CLICKS_ALL, "clicks"),
    "dim_products": _sql(
        "SELECT product_id, name, category, CAST(price AS DOUBLE) AS price FROM products", "products"
    ),
    "dim_stores": _sql("SELECT store_id, name, city, state, country FROM stores", "stores"),
    # Deduplication, incremental loads, merges
    "latest_per_key": _sql(
        """SELECT event_id, us AS ts, user_id, event_type, value, k FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
        FROM ev) WHERE rn = 1""",
        "ev",
    ),
    "latest_per_composite_key": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate,
        l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC,
        l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "lookback_filter": _sql(
        """SELECT event_id, us AS ts FROM ev
        WHERE ts >= (SELECT MAX(ts) - INTERVAL 86400 SECOND FROM ev WHERE event_type = 'error')""",
        "ev",
    ),
    "stage_incremental": _sql(
        f"""{_PAYMENTS} batch UNION ALL
        {_PAYMENTS} loaded WHERE payment_id NOT IN (SELECT payment_id FROM batch)""",
        "versions_payments",
        loaded=_latest("payments", "versions_payments", "ce_time < epoch_us(TIMESTAMP '1998-07-01')"),
        batch=_latest(
            "payments",
            "versions_payments",
            "ce_time >= (SELECT MAX(ce_time) - 15000000 FROM loaded)",
        ),
    ),
    "stage_stream": _stage("payments"),
    # Versions 1 to 3 are the three slices; those of the last come after newer ones.
    "late_rows_report": _sql(
        """SELECT * FROM (VALUES (CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)), (2, 0, 0))
          AS v(version, late_rows, untimed_rows)
        UNION ALL SELECT 3, COUNT(*), 0 FROM versions_payments
        WHERE year(make_timestamp(ce_time)) BETWEEN 1998 AND 1999""",
        "versions_payments",
    ),
    **{f"stage_{name}": _stage(name) for name in ENTITY_COLUMNS},
    # Marts
    "customer_orders": _sql("SELECT * FROM customer_orders", "customer_orders"),
    "materialize_view": _sql("SELECT * FROM customer_orders", "customer_orders"),
    "customer_payments": _sql(
        "SELECT customer_id, CAST(total_amount AS DOUBLE) AS total_amount FROM customer_payments",
        "customer_payments",
    ),
    "dim_customers": _sql(
        """SELECT * REPLACE (CAST(customer_lifetime_value AS DOUBLE) AS customer_lifetime_value)
        FROM dim_customers""",
        "dim_customers",
    ),
    "order_payments_pivot": _sql(
        f"SELECT order_id, {_METHOD_AMOUNTS}, CAST(total_amount AS DOUBLE) AS total_amount FROM order_payments",
        "order_payments",
    ),
    "fact_orders": _sql(_FACT_ORDERS, "fact_orders"),
    "materialize_table": _sql(_FACT_ORDERS, "fact_orders"),
    "fact_order_items": _sql(_ITEMS, "fact_order_items"),
    "fact_order_items_salted": _sql(_ITEMS, "fact_order_items"),
    "dim_date": _sql("SELECT * FROM dim_date", "dim_date"),
    "dim_date_generated": _sql(
        """SELECT day AS date_day, year(day) AS year, quarter(day) AS quarter, month(day) AS month,
          left(monthname(day), 3) AS month_name, weekofyear(day) AS week_of_year, day(day) AS day_of_month,
          dayofweek(day) AS day_of_week, left(dayname(day), 3) AS day_name,
          dayofweek(day) IN (0, 6) AS is_weekend, n_rows FROM counted""",
        "shop_orders",
        counted="""SELECT day, COUNT(*) AS n_rows FROM (SELECT order_date AS day FROM shop_orders
          UNION ALL SELECT CAST(ts AS DATE) FROM events) GROUP BY day""",
    ),
    "build_fact_orders": _sql(
        f"""SELECT {_ORDER_COLUMNS}, {_METHOD_AMOUNTS}, CAST(total_amount AS DOUBLE) AS amount
        FROM shop_orders LEFT JOIN paid USING (order_id)""",
        "shop_orders",
        "versions_payments",
        staged=_latest("payments", "versions_payments"),
        paid=f"SELECT order_id, {_BY_METHOD}, SUM(amount) AS total_amount FROM staged GROUP BY order_id",
    ),
    # Row and column security
    **{
        f"row_access_{name}": _sql(
            f"SELECT * FROM shop_orders WHERE {_visible(user, 'order', 'order_id')}",
            "shop_orders",
            "entitlements",
        )
        for name, user in (("wildcard", 2), ("scoped", 101), ("denied", 103))
    },
    "row_access_many": _sql(
        f"SELECT * FROM shop_orders WHERE {_visible(7, 'order', 'order_id', 'many')}",
        "shop_orders",
        many="""SELECT 7 AS user_id, 'order' AS resource, o_custkey % 3 AS access_level,
          CAST(o_orderkey AS VARCHAR) AS object_id FROM orders WHERE o_orderkey % 2 = 0""",
    ),
    "mask_pii": _sql(
        f"""SELECT customer_id, {_text("first_name", 3, "customer")} AS name_for_3,
        {_text("first_name", 2, "customer")} AS name_for_2 FROM customers""",
        "customers",
        "entitlements",
    ),
    "mask_financial": _sql(
        f"""SELECT payment_id, {_amount("amount", 1, "payment")} AS amount_for_1,
        {_amount("amount", 5, "payment")} AS amount_for_5 FROM payments""",
        "payments",
        "entitlements",
    ),
    "apply_masks": _sql(
        f"""SELECT customer_id, {_text("first_name", 3, "customer")} AS first_name,
        {_text("last_name", 3, "store")} AS last_name, first_order, most_recent_order,
        {_amount("number_of_orders", 3, "order", "BIGINT")} AS number_of_orders,
        {_amount("customer_lifetime_value", 3, "customer")} AS customer_lifetime_value FROM dim_customers""",
        "dim_customers",
        "entitlements",
    ),
    "sv_dim_customers": _sql(
        f"""SELECT * REPLACE ({_text("first_name", 3, "customer")} AS first_name,
        {_text("last_name", 3, "customer")} AS last_name,
        {_amount("customer_lifetime_value", 3, "customer")} AS customer_lifetime_value)
        FROM dim_customers WHERE {_visible(3, "customer", "customer_id")}""",
        "dim_customers",
        "entitlements",
    ),
    "sv_fact_orders": _sql(
        f"""SELECT {_ORDER_COLUMNS}, {", ".join(f"{_amount(c, 101, 'order')} AS {c}" for c in _AMOUNTS)}
        FROM fact_orders WHERE {_visible(101, "order", "order_id")}""",
        "fact_orders",
        "entitlements",
    ),
    "sv_fact_order_items": _sql(
        f"""SELECT order_item_id, order_id, product_id, quantity,
        {_amount("unit_price", 4, "order_item")} AS unit_price,
        {_amount("line_total", 4, "order_item")} AS line_total
        FROM fact_order_items WHERE {_visible(4, "order_item", "order_item_id")}""",
        "fact_order_items",
        "entitlements",
    ),
    "sv_dim_products": _sql(
        f"""SELECT product_id, name, category, {_amount("price", 4, "product")} AS price
        FROM products WHERE {_visible(4, "product", "product_id")}""",
        "products",
        "entitlements",
    ),
    "sv_dim_stores": _sql(
        f"SELECT * FROM stores WHERE {_visible(4, 'store', 'store_id')}", "stores", "entitlements"
    ),
    "sv_dim_date": _sql("SELECT * FROM dim_date", "dim_date"),
    "role_mask": _sql(
        """SELECT customer_id, first_name, last_name, number_of_orders, 'ANALYST' AS role FROM dim_customers
        UNION ALL SELECT customer_id, '***', '***', number_of_orders, 'ANALYST_NO_PII' FROM dim_customers""",
        "dim_customers",
    ),
    "region_access": _sql(
        """SELECT * FROM customers_demo c WHERE EXISTS (SELECT 1 FROM principals p
        WHERE p.principal = 'ANALYST_EU' AND p.is_active AND (p.region = c.region OR p.region = 'ALL'))""",
        "customers_demo",
        "principals",
    ),
    "region_access_all": _sql(
        """SELECT * FROM customers_demo c WHERE EXISTS (SELECT 1 FROM principals p
        WHERE p.principal = 'DATA_STEWARD' AND p.is_active AND (p.region = c.region OR p.region = 'ALL'))""",
        "customers_demo",
        "principals",
    ),
    "clearance_mask": _sql(
        """SELECT p.principal, c.customer_id, CASE WHEN p.cleared THEN c.full_name ELSE '***MASKED***' END AS full_name,
        CASE WHEN p.cleared THEN c.email ELSE '***MASKED***' END AS email, c.region
        FROM customers_demo c, (SELECT principal, bool_or(is_active AND pii_clearance) AS cleared FROM principals
          WHERE principal IN ('DATA_STEWARD', 'EX_STEWARD') GROUP BY principal) p""",
        "customers_demo",
        "principals",
    ),
    "active_entitlements": _sql("SELECT * FROM entitlements WHERE access_level > 0", "entitlements"),
    "entitlement_checks": _sql(
        """SELECT 'access_level' AS check_name, CAST(access_level AS VARCHAR) AS detail, COUNT(*) AS failures
        FROM faulty_grants WHERE access_level NOT IN (0, 1, 2) GROUP BY ALL
        UNION ALL SELECT 'not_null', 'resource', COUNT(*) FROM faulty_grants WHERE resource IS NULL
        UNION ALL SELECT 'primary_key', concat_ws('/', user_id, resource, object_id), COUNT(*) FROM faulty_grants
        WHERE resource IS NOT NULL GROUP BY user_id, resource, object_id HAVING COUNT(*) > 1""",
        "faulty_grants",
    ),
    "query_as_user": _sql(
        """SELECT status, year, strftime(first_date, '%Y-%m-%d') AS first_date, n_orders, revenue FROM (
        SELECT o.status, d.year, MIN(o.order_date) AS first_date, COUNT(*) AS n_orders,
          CAST(SUM(o.amount) AS DOUBLE) AS revenue
        FROM fact_orders o JOIN dim_date d ON o.order_date = d.date_day GROUP BY o.status, d.year)
        ORDER BY revenue DESC, status, year""",
        "fact_orders",
        "dim_date",
    ),
    "query_as_user_all_rows": _sql(
        f"""SELECT order_id, status, {_amount("amount", 3, "order")} AS amount
        FROM fact_orders WHERE {_visible(3, "order", "order_id")}""",
        "fact_orders",
        "entitlements",
    ),
    # Semantic model
    "sem_totals": _sql(
        """SELECT (SELECT CAST(SUM(amount) AS DOUBLE) FROM fact_orders) AS total_revenue,
        (SELECT COUNT(order_id) FROM fact_orders) AS order_count,
        (SELECT COUNT(DISTINCT customer_id) FROM dim_customers) AS customer_count,
        (SELECT CAST(SUM(line_total) AS DOUBLE) FROM fact_order_items) AS total_product_revenue,
        (SELECT CAST(SUM(quantity) AS BIGINT) FROM fact_order_items) AS total_units_sold""",
        "fact_orders",
        "dim_customers",
        "fact_order_items",
    ),
    "sem_order_count": _sql("SELECT COUNT(order_id) AS order_count FROM fact_orders", "fact_orders"),
    "sem_revenue_by_category": _sql(
        f"""SELECT p.category AS products_category, CAST(SUM(i.line_total) AS DOUBLE) AS total_product_revenue
        {_JOINED_ITEMS} GROUP BY ALL""",
        "fact_order_items",
        *_STAR,
    ),
    "sem_revenue_by_customer": _sql(
        f"""SELECT c.customer_id AS customers_customer_id, c.last_name AS customers_last_name,
        CAST(SUM(o.amount) AS DOUBLE) AS total_revenue {_JOINED_ORDERS} GROUP BY ALL""",
        *_STAR,
    ),
    "sem_top_customers": _sql(
        f"""SELECT c.customer_id AS customers_customer_id, COUNT(o.order_id) AS order_count {_JOINED_ORDERS}
        GROUP BY ALL ORDER BY order_count DESC, customers_customer_id ASC NULLS LAST LIMIT 5""",
        *_STAR,
    ),
    "sem_orders_by_store_top10": _sql(
        f"""SELECT s.store_id AS stores_store_id, s.name AS stores_name, COUNT(o.order_id) AS order_count
        {_JOINED_ORDERS} GROUP BY ALL ORDER BY order_count DESC, stores_store_id ASC NULLS LAST LIMIT 10""",
        *_STAR,
    ),
    "sem_units_by_quarter": _sql(
        f"""SELECT d.year AS dates_year, d.quarter AS dates_quarter,
        CAST(SUM(i.quantity) AS BIGINT) AS total_units_sold {_JOINED_ITEMS} GROUP BY ALL""",
        "fact_order_items",
        *_STAR,
    ),
    "sem_orders_by_status": _sql(
        """SELECT status AS orders_status, COUNT(order_id) AS order_count,
        CAST(SUM(amount) AS DOUBLE) AS total_revenue FROM fact_orders GROUP BY ALL""",
        "fact_orders",
    ),
    "sem_items_and_orders_by_state": _sql(
        """SELECT stores_state, dates_is_weekend, orders_status, total_revenue, total_product_revenue,
        total_units_sold, order_count FROM o FULL JOIN i USING (stores_state, dates_is_weekend, orders_status)""",
        "fact_order_items",
        *_STAR,
        o=f"""SELECT s.state AS stores_state, d.is_weekend AS dates_is_weekend, o.status AS orders_status,
        CAST(SUM(o.amount) AS DOUBLE) AS total_revenue, COUNT(o.order_id) AS order_count
        {_JOINED_ORDERS} GROUP BY ALL""",
        i=f"""SELECT s.state AS stores_state, d.is_weekend AS dates_is_weekend, o.status AS orders_status,
        CAST(SUM(i.line_total) AS DOUBLE) AS total_product_revenue,
        CAST(SUM(i.quantity) AS BIGINT) AS total_units_sold {_JOINED_ITEMS} GROUP BY ALL""",
    ),
    "sem_secured_user3": _sql(
        f"""SELECT c.customer_id AS customers_customer_id, c.first_name AS customers_first_name,
        COUNT(o.order_id) AS order_count {_JOINED_ORDERS} GROUP BY ALL""",
        *_STAR,
    ),
    "sem_secured_user4": _sql(
        f"""SELECT s.store_id AS stores_store_id, CAST(SUM(o.amount) AS DOUBLE) AS total_revenue
        {_JOINED_ORDERS} WHERE s.store_id = 5 GROUP BY ALL""",
        *_STAR,
    ),
    "sem_secured_user5": _sql(
        """SELECT CAST(SUM(amount) AS DOUBLE) AS total_revenue FROM fact_orders
        WHERE order_date >= DATE '1998-06-01' AND order_date < DATE '1998-07-01'""",
        "fact_orders",
    ),
    # Data quality
    "dq_unique": """SELECT l_orderkey * 8 + l_linenumber AS order_item_id, COUNT(*) AS n_records
        FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1""",
    "dq_not_null": _sql(
        "SELECT column_name, n_nulls FROM counted WHERE n_nulls > 0",
        "fact_orders",
        counted=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) AS n_nulls FROM fact_orders WHERE {c} IS NULL"
            for c in (
                *_ORDER_COLUMNS.split(", "),
                *[f"{m}_amount" for m in PAYMENT_METHODS],
                "amount",
            )
        ),
    ),
    "dq_accepted_values": f"""SELECT event_type AS value_field, COUNT(*) AS n_records FROM events
        WHERE event_type NOT IN {CLICK_ACTIONS} GROUP BY ALL""",
    "dq_clicks": """SELECT test, column_name, failures FROM (
        SELECT 'accepted_values' AS test, 'page_type' AS column_name, COUNT(*) AS failures FROM events
        WHERE event_type IN ('view', 'click', 'purchase') AND event_id % 7 = 0
        UNION ALL SELECT 'not_null', 'customer_id', COUNT(*) FROM events
        WHERE event_type IN ('view', 'click', 'purchase') AND event_id % 11 = 0) WHERE failures > 0""",
    "dq_all_tests": """SELECT test, column_name, failures FROM (
        SELECT 'unique' AS test, 'payment_id' AS column_name, COUNT(*) AS failures FROM (
          SELECT 1 FROM lineitem GROUP BY l_orderkey * 8 + l_linenumber HAVING COUNT(*) > 1)
        UNION ALL SELECT 'not_null', 'amount', COUNT(*) FROM lineitem WHERE NOT l_discount > 0.05
        UNION ALL SELECT 'accepted_values', 'payment_method', COUNT(*) FROM lineitem WHERE l_tax > 0.05)
        WHERE failures > 0""",
}

_MERGED = """SELECT event_id, us AS ts, user_id, event_type, value, k FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, k
      ORDER BY list_position(['view', 'signup', 'error', 'click', 'purchase'], event_type) DESC,
        ts DESC NULLS FIRST, event_id DESC) AS rn FROM ev) WHERE rn = 1"""
ORACLES["merge_upsert"] = _sql(_MERGED, "ev")
ORACLES["merge_upsert_table"] = _sql(_MERGED, "ev")
