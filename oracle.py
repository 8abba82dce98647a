"""DuckDB oracle: the results of every registered query, computed another way.

Feed projections, cleaning, keep-first, validation and staging are CTEs over the
given tables. The sold lines are one denormalised relation (``sold``), built by
looking up each line's order, product, customer, store, day and payment state;
every report is a grouping of that relation, rendered from a short declaration
(keys, measures, ranking). The star schema is a projection of it.
"""

from __future__ import annotations

BASE = """
WITH
feed_customers AS (
  SELECT c_custkey AS customer_id,
         '  ' || split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) || ' ' AS last_name,
         CASE WHEN c_custkey % 50 = 3 THEN NULL
              ELSE ' Customer' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END AS email,
         CASE WHEN c_custkey % 50 = 7 THEN 'not-a-date'
              ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS VARCHAR) END AS signup_date,
         c_custkey AS seq
  FROM customer),
cust_typed AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
         lower(trim(email)) AS email, TRY_CAST(signup_date AS DATE) AS signup_date, seq
  FROM feed_customers),
cust_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq) AS rn FROM cust_typed) WHERE rn = 1),
cust_tagged AS (
  SELECT *, (customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
             AND email IS NOT NULL AND signup_date IS NOT NULL) AS ok FROM cust_first),
raw_customers AS (
  SELECT customer_id, first_name, last_name, email, CAST(NULL AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS country,
         signup_date
  FROM cust_tagged WHERE ok),
feed_stores AS (
  SELECT s_suppkey AS store_id, ' ' || s_name AS store_name, n_name AS city, r_name AS country, s_suppkey AS seq
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
store_typed AS (
  SELECT store_id, trim(store_name) AS store_name, trim(city) AS city, CAST(NULL AS VARCHAR) AS state,
         trim(country) AS country, seq FROM feed_stores),
store_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY seq) AS rn FROM store_typed) WHERE rn = 1),
store_tagged AS (SELECT *, (store_id IS NOT NULL AND store_name IS NOT NULL) AS ok FROM store_first),
raw_stores AS (SELECT store_id, store_name, city, state, country FROM store_tagged WHERE ok),
feed_products AS (
  SELECT p_partkey AS product_id, p_name || ' ' AS product_name,
         CASE WHEN p_partkey % 9 = 4 THEN NULL ELSE p_type END AS category,
         CAST((CASE WHEN p_partkey % 50 = 1 THEN -1 ELSE 1 END)
              * CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) * 0.01 AS DECIMAL(12,2)) AS price,
         p_partkey AS seq
  FROM part),
prod_typed AS (
  SELECT product_id, trim(product_name) AS product_name, trim(category) AS category, price,
         CAST(NULL AS BIGINT) AS store_id, seq FROM feed_products),
prod_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) AS rn FROM prod_typed) WHERE rn = 1),
prod_tagged AS (
  SELECT *, (product_id IS NOT NULL AND product_name IS NOT NULL AND price IS NOT NULL AND price >= 0) AS ok
  FROM prod_first),
raw_products AS (SELECT product_id, product_name, category, price, store_id FROM prod_tagged WHERE ok),
feed_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 97 = 5 THEN -1 ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 12 END AS store_id,
         CASE WHEN o_orderkey % 50 = 11 THEN '31-31-2026' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
         CASE o_orderstatus WHEN 'O' THEN 'placed' WHEN 'F' THEN 'delivered' ELSE NULL END AS order_status,
         CAST(o_orderdate AS TIMESTAMP) AS updated_at,
         o_orderkey AS seq
  FROM orders),
ord_typed AS (
  SELECT order_id, customer_id, store_id, TRY_CAST(order_date AS DATE) AS order_date,
         trim(order_status) AS order_status, updated_at, seq FROM feed_orders),
ord_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq) AS rn FROM ord_typed) WHERE rn = 1),
ord_tagged AS (
  SELECT *, (order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL) AS ok FROM ord_first),
raw_orders AS (SELECT order_id, customer_id, store_id, order_date, order_status FROM ord_tagged WHERE ok),
feed_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
         l_orderkey AS order_id,
         l_partkey AS product_id,
         CASE WHEN l_orderkey % 53 = 7 THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CAST((CASE WHEN l_orderkey % 59 = 9 THEN -1 ELSE 1 END)
              * (CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) // CAST(l_quantity AS INTEGER)) * 0.01 AS DECIMAL(12,2)) AS unit_price,
         CASE WHEN l_orderkey % 61 = 4 THEN NULL
              ELSE CAST(((CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * CAST(floor(l_discount * 100 + 0.5) AS BIGINT)) // 100) * 0.01 AS DECIMAL(12,2)) END AS discount,
         l_partkey, l_suppkey, l_shipdate, l_tax
  FROM lineitem),
item_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_item_id
        ORDER BY l_partkey, l_suppkey, l_shipdate, quantity, unit_price,
                 (discount IS NOT NULL), discount NULLS FIRST, l_tax) AS rn
    FROM feed_items) WHERE rn = 1),
item_tagged AS (
  SELECT *, (order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL
             AND quantity IS NOT NULL AND unit_price IS NOT NULL
             AND coalesce(quantity > 0, false) AND coalesce(unit_price >= 0, false)
             AND coalesce(discount >= 0, false) AND coalesce(discount <= quantity * unit_price, false)) AS ok
  FROM item_first),
raw_order_items AS (
  SELECT order_item_id, order_id, product_id, quantity, unit_price, discount FROM item_tagged WHERE ok),
feed_payments AS (
  SELECT event_id AS payment_id, event_id // 2 AS order_id,
         CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'pending'
                         WHEN 'signup' THEN 'refunded' WHEN 'click' THEN 'unknown_status' END AS payment_status,
         CAST((CASE WHEN event_id % 50 = 1 THEN -1 ELSE 1 END)
              * CAST(floor(value * 100 + 0.5) AS BIGINT) * 0.01 AS DECIMAL(12,2)) AS amount,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS payment_date,
         event_id AS seq
  FROM events),
pay_typed AS (
  SELECT payment_id, order_id, CAST(NULL AS VARCHAR) AS payment_method, amount, trim(payment_status) AS payment_status,
         TRY_CAST(payment_date AS DATE) AS payment_date, seq FROM feed_payments),
pay_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY seq) AS rn FROM pay_typed) WHERE rn = 1),
pay_tagged AS (
  SELECT *, (payment_id IS NOT NULL AND order_id IS NOT NULL AND amount IS NOT NULL AND payment_status IS NOT NULL
             AND coalesce(amount >= 0, false)
             AND coalesce(payment_status IN ('failed', 'pending', 'refunded', 'success'), false)) AS ok
  FROM pay_first),
raw_payments AS (
  SELECT payment_id, order_id, payment_method, amount, payment_status, payment_date FROM pay_tagged WHERE ok),
stg_customers AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, lower(trim(email)) AS email,
         phone, city, state, country, signup_date FROM raw_customers),
stg_products AS (
  SELECT product_id, trim(product_name) AS product_name, coalesce(trim(category), 'Uncategorized') AS category,
         price, store_id FROM raw_products),
stg_stores AS (SELECT store_id, trim(store_name) AS store_name, city, state, country FROM raw_stores),
stg_orders AS (
  SELECT order_id, customer_id, store_id, order_date, coalesce(order_status, 'unknown') AS order_status FROM raw_orders),
stg_order_items AS (
  SELECT order_item_id, order_id, product_id, quantity, unit_price, coalesce(discount, 0) AS discount
  FROM raw_order_items),
stg_payments AS (SELECT * FROM raw_payments),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, first_name, last_name, email,
         city, state, country, signup_date FROM stg_customers),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category, price
  FROM stg_products),
dim_store AS (
  SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_name, city, state, country
  FROM stg_stores),
date_spine AS (
  SELECT CAST(d AS DATE) AS full_date
  FROM (SELECT unnest(generate_series(make_date(min(year(order_date)), 1, 1), make_date(max(year(order_date)), 12, 31), INTERVAL 1 DAY)) AS d
        FROM raw_orders)),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(extract(year FROM full_date) AS INTEGER) AS year,
         CAST(extract(quarter FROM full_date) AS INTEGER) AS quarter,
         CAST(extract(month FROM full_date) AS INTEGER) AS month,
         strftime(full_date, '%B') AS month_name,
         CAST(extract(day FROM full_date) AS INTEGER) AS day,
         CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
         strftime(full_date, '%A') AS day_name,
         isodow(full_date) IN (6, 7) AS is_weekend
  FROM date_spine),
latest_payment AS (
  SELECT order_id, max_by(payment_status, (payment_date IS NOT NULL, payment_date, payment_id)) AS payment_status
  FROM stg_payments GROUP BY order_id),
sold AS (
  SELECT i.*, CAST(i.quantity * i.unit_price - i.discount AS DECIMAL(18,2)) AS total_amount,
         customer_id, first_name, last_name, customer_key, product_name, category, product_key,
         store_id, s.store_name, s.city AS store_city, store_key,
         full_date, year, month, month_name, is_weekend, date_key,
         coalesce(pay.payment_status, 'pending') AS payment_status
  FROM stg_orders
  JOIN (SELECT date_key, full_date AS order_date, full_date, year, month, month_name, is_weekend FROM dim_date) USING (order_date)
  JOIN (SELECT customer_key, customer_id, first_name, last_name FROM dim_customer) USING (customer_id)
  LEFT JOIN (SELECT store_key, store_id, store_name, city FROM dim_store) AS s USING (store_id)
  LEFT JOIN latest_payment AS pay USING (order_id)
  JOIN stg_order_items AS i USING (order_id)
  JOIN (SELECT product_key, product_id, product_name, category FROM dim_product) USING (product_id)),
fact_sales AS (
  SELECT dense_rank() OVER (ORDER BY order_id, order_item_id) AS sale_id, order_item_id, order_id, customer_key,
         product_key, store_key, date_key, quantity, unit_price, discount, 0::DECIMAL(12,2) AS tax, total_amount,
         payment_status
  FROM sold),
int_order_metrics AS (
  SELECT DISTINCT order_id, count(*) OVER per AS item_count, sum(quantity) OVER per AS total_quantity,
         sum(quantity * unit_price - discount) OVER per AS order_subtotal
  FROM stg_order_items WINDOW per AS (PARTITION BY order_id)),
int_customer_orders AS (
  SELECT customer_id, count(*) AS total_orders, sum(order_subtotal) AS lifetime_spend,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM stg_orders SEMI JOIN stg_order_items USING (order_id) JOIN int_order_metrics USING (order_id)
  GROUP BY customer_id)
"""

M = "DECIMAL(38,2)"

# what a measure means, over the rows of one group
MONEY = f"sum(total_amount)::{M}"
ORDERS = "count(DISTINCT order_id)"
UNITS = "sum(quantity)::BIGINT"
LINES = "count(*)"
RATIO = "sum(total_amount)::DOUBLE / nullif(count(DISTINCT order_id), 0)"


def grouping(keys: list[str], measures: dict[str, str], where: str = "true", source: str = "sold", best: tuple | None = None) -> str:
    """``measures`` per ``keys`` (a key may be "expression AS name"); ``best`` keeps
    the first n groups by (measure descending, tie-break)."""
    columns = [*keys, *(f"{expr} AS {name}" for name, expr in measures.items())]
    sql = f"SELECT {', '.join(columns)} FROM {source} WHERE {where}" + (" GROUP BY ALL" if keys else "")
    if best:
        measure, tie, n = best
        sql = f"SELECT * FROM ({sql}) QUALIFY row_number() OVER (ORDER BY {measure} DESC, {tie}) <= {n}"
    return sql


CUSTOMER, PRODUCT = ["customer_id", "first_name", "last_name"], ["product_id", "product_name", "category"]
STORE = ["store_id", "store_name", "store_city AS city"]
HAS_STORE = "store_key IS NOT NULL"
# bronze lines, without the model's lookups
LINE = "(SELECT *, (quantity * unit_price - discount)::DECIMAL(18,2) AS total_amount FROM raw_order_items)"

REPORT_SQL = {
    "total_revenue": grouping([], {"total_revenue": MONEY}),
    "daily_revenue": grouping(["full_date"], {"daily_revenue": MONEY, "order_count": ORDERS}),
    "monthly_revenue": grouping(["year", "month", "month_name"], {"monthly_revenue": MONEY}),
    "average_order_value": grouping([], {"average_order_value": RATIO}),
    "revenue_by_category": grouping(["category"], {"category_revenue": MONEY}),
    "top_customers_ltv": grouping(CUSTOMER, {"lifetime_spend": MONEY, "total_orders": ORDERS}, best=("lifetime_spend", "customer_id", 10)),
    "new_customers_by_month": grouping(["make_date(year(signup_date), month(signup_date), 1) AS signup_month"], {"new_customers": LINES},
                                       where="signup_date IS NOT NULL", source="dim_customer"),
    "repeat_customer_rate": grouping([], {"repeat_customer_rate": "avg((n > 1)::INTEGER)"},
                                     source="(SELECT len(list_distinct(list(order_id))) AS n FROM sold GROUP BY customer_id)"),
    "top_products": grouping(PRODUCT, {"product_revenue": MONEY, "units_sold": UNITS}, best=("product_revenue", "product_id", 10)),
    "category_performance": grouping(["category"], {"category_revenue": MONEY, "units_sold": UNITS, "orders_containing_category": ORDERS}),
    "payment_status_share": grouping(["payment_status"], {"line_items": LINES, "pct_of_total": "round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM sold), 2)"}),
    "sales_by_store": grouping(STORE, {"store_revenue": MONEY, "orders_fulfilled": ORDERS}, where=HAS_STORE),
    "weekday_weekend": grouping(["is_weekend"], {"revenue": MONEY, "order_count": ORDERS}),
    "dash_total_revenue": grouping([], {"total_revenue": f"coalesce({MONEY}, 0)"}),
    "dash_total_orders": grouping([], {"total_orders": ORDERS}),
    "dash_total_customers": grouping([], {"total_customers": LINES}, source="raw_customers"),
    "dash_aov": grouping([], {"aov": f"coalesce({RATIO}, 0)"}),
    "dash_revenue_by_date": grouping(["full_date"], {"revenue": MONEY}),
    "dash_revenue_by_category": grouping(["category"], {"revenue": MONEY}),
    "dash_top_products": grouping(["product_name"], {"revenue": MONEY}, best=("revenue", "product_name", 10)),
    "dash_top_customers": grouping(["concat_ws(' ', first_name, last_name) AS customer_name"], {"revenue": MONEY}, best=("revenue", "customer_name", 10)),
    "dash_payment_status": grouping(["payment_status"], {"line_items": LINES}),
    "dash_sales_by_store": grouping(["store_name"], {"revenue": MONEY}, where=HAS_STORE),
    "raw_total_revenue": grouping([], {"total_revenue": f"coalesce({MONEY}, 0)"}, source=LINE),
    "raw_revenue_by_date": grouping(["order_date"], {"revenue": MONEY}, where="order_date IS NOT NULL", source=f"{LINE} JOIN raw_orders USING (order_id)"),
    "raw_top_products": grouping(["product_name"], {"revenue": MONEY}, source=f"{LINE} JOIN raw_products USING (product_id)", best=("revenue", "product_name", 10)),
    "raw_average_order_value": grouping([], {"average_order_value": f"coalesce({RATIO}, 0)"}, source=LINE),
}


def oracle_queries() -> dict[str, str]:
    return {k: BASE + v for k, v in REPORT_SQL.items()}


def _case(first: list[tuple[str, str]]) -> str:
    def lit(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    return "CASE " + " ".join(f"WHEN {cond} THEN {lit(reason)}" for cond, reason in first) + " END"


def _nn(cols: list[str]) -> list[tuple[str, str]]:
    return [(f"{c} IS NULL", f"null in required column {c}") for c in cols]


_REASONS = {
    "customers": ("cust_tagged", _nn(["customer_id", "first_name", "last_name", "email", "signup_date"])),
    "stores": ("store_tagged", [("store_id IS NULL OR store_name IS NULL", "missing store_id or store_name")]),
    "products": ("prod_tagged", _nn(["product_id", "product_name", "price"])
                 + [("NOT coalesce(price >= 0, false)", "price must not be negative")]),
    "orders": ("ord_tagged", _nn(["order_id", "customer_id", "order_date"])),
    "order_items": ("item_tagged", _nn(["order_item_id", "order_id", "product_id", "quantity", "unit_price"]) + [
        ("NOT coalesce(quantity > 0, false)", "quantity must be greater than 0"),
        ("NOT coalesce(unit_price >= 0, false)", "unit_price must not be negative"),
        ("NOT coalesce(discount >= 0, false)", "discount must not be negative"),
        ("NOT coalesce(discount <= quantity * unit_price, false)", "discount must not exceed quantity * unit_price"),
    ]),
    "payments": ("pay_tagged", _nn(["payment_id", "order_id", "amount", "payment_status"]) + [
        ("NOT coalesce(amount >= 0, false)", "amount must not be negative"),
        ("NOT coalesce(payment_status IN ('failed', 'pending', 'refunded', 'success'), false)",
         "payment_status must be one of ['failed', 'pending', 'refunded', 'success']"),
    ]),
}

_TAGGED = {t: cte for t, (cte, _) in _REASONS.items()}

_DRY = {
    "customers": ("feed_customers", ["customer_id", "first_name", "last_name", "email", "signup_date"]),
    "products": ("feed_products", ["product_id", "product_name", "price"]),
    "orders": ("feed_orders", ["order_id", "customer_id", "order_date"]),
    "order_items": ("feed_items", ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]),
    "payments": ("feed_payments", ["payment_id", "order_id", "amount", "payment_status"]),
}


# The generic model tests
# (model, column, test, parent model, parent column, severity).
GENERIC_TESTS = [
    ("stg_customers", "customer_id", "not_null", None, None, "error"),
    ("stg_customers", "customer_id", "unique", None, None, "error"),
    ("stg_customers", "email", "not_null", None, None, "error"),
    ("stg_products", "product_id", "not_null", None, None, "error"),
    ("stg_products", "product_id", "unique", None, None, "error"),
    ("stg_products", "price", "not_null", None, None, "error"),
    ("stg_stores", "store_id", "not_null", None, None, "error"),
    ("stg_stores", "store_id", "unique", None, None, "error"),
    ("stg_orders", "order_id", "not_null", None, None, "error"),
    ("stg_orders", "order_id", "unique", None, None, "error"),
    ("stg_orders", "customer_id", "not_null", None, None, "error"),
    ("stg_orders", "customer_id", "relationships", "stg_customers", "customer_id", "error"),
    ("stg_order_items", "order_item_id", "not_null", None, None, "error"),
    ("stg_order_items", "order_item_id", "unique", None, None, "error"),
    ("stg_order_items", "order_id", "not_null", None, None, "error"),
    ("stg_order_items", "order_id", "relationships", "stg_orders", "order_id", "warn"),
    ("stg_order_items", "product_id", "not_null", None, None, "error"),
    ("stg_order_items", "product_id", "relationships", "stg_products", "product_id", "error"),
    ("stg_order_items", "quantity", "not_null", None, None, "error"),
    ("stg_payments", "payment_id", "not_null", None, None, "error"),
    ("stg_payments", "payment_id", "unique", None, None, "error"),
    ("stg_payments", "order_id", "not_null", None, None, "error"),
    ("stg_payments", "order_id", "relationships", "stg_orders", "order_id", "warn"),
    ("stg_payments", "payment_status", "accepted_values", None, None, "error"),
    ("dim_customer", "customer_key", "not_null", None, None, "error"),
    ("dim_customer", "customer_key", "unique", None, None, "error"),
    ("dim_customer", "customer_id", "not_null", None, None, "error"),
    ("dim_customer", "customer_id", "unique", None, None, "error"),
    ("dim_product", "product_key", "not_null", None, None, "error"),
    ("dim_product", "product_key", "unique", None, None, "error"),
    ("dim_product", "product_id", "not_null", None, None, "error"),
    ("dim_product", "product_id", "unique", None, None, "error"),
    ("dim_store", "store_key", "not_null", None, None, "error"),
    ("dim_store", "store_key", "unique", None, None, "error"),
    ("dim_store", "store_id", "not_null", None, None, "error"),
    ("dim_store", "store_id", "unique", None, None, "error"),
    ("dim_date", "date_key", "not_null", None, None, "error"),
    ("dim_date", "date_key", "unique", None, None, "error"),
    ("dim_date", "full_date", "not_null", None, None, "error"),
    ("dim_date", "full_date", "unique", None, None, "error"),
    ("fact_sales", "sale_id", "not_null", None, None, "error"),
    ("fact_sales", "sale_id", "unique", None, None, "error"),
    ("fact_sales", "order_item_id", "not_null", None, None, "error"),
    ("fact_sales", "customer_key", "not_null", None, None, "error"),
    ("fact_sales", "customer_key", "relationships", "dim_customer", "customer_key", "error"),
    ("fact_sales", "product_key", "not_null", None, None, "error"),
    ("fact_sales", "product_key", "relationships", "dim_product", "product_key", "error"),
    ("fact_sales", "date_key", "not_null", None, None, "error"),
    ("fact_sales", "date_key", "relationships", "dim_date", "date_key", "error"),
    ("fact_sales", "quantity", "not_null", None, None, "error"),
    ("fact_sales", "total_amount", "not_null", None, None, "error"),
]


def _test_name(m, c, kind, pm, pf) -> str:
    if kind == "relationships":
        return f"relationships_{m}_{c}__{pf}__{pm}"
    return f"{kind}_{m}_{c}"


def _model_tests_sql() -> str:
    parts = []
    for m, c, kind, pm, pf, severity in GENERIC_TESTS:
        if kind == "not_null":
            q = f"SELECT count(*) FROM {m} WHERE {c} IS NULL"
        elif kind == "unique":
            q = f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        elif kind == "relationships":
            q = (f"SELECT count(*) FROM {m} AS child LEFT JOIN {pm} AS parent ON child.{c} = parent.{pf} "
                 f"WHERE child.{c} IS NOT NULL AND parent.{pf} IS NULL")
        else:
            q = (f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} NOT IN "
                 f"('success', 'failed', 'pending', 'refunded') GROUP BY {c})")
        parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, '{_test_name(m, c, kind, pm, pf)}' AS test_name, "
                     f"'{severity}' AS severity, CAST(({q}) AS BIGINT) AS failures")
    singular = [
        ("assert_fact_grain_unique", "order_id,order_item_id",
         "SELECT count(*) FROM (SELECT order_id, order_item_id FROM fact_sales GROUP BY order_id, order_item_id HAVING count(*) > 1)"),
        ("assert_positive_revenue", "total_amount", "SELECT count(*) FROM fact_sales WHERE total_amount < 0"),
        ("assert_valid_orders", "order_id",
         "SELECT count(*) FROM stg_orders o LEFT JOIN (SELECT DISTINCT order_id FROM fact_sales) f "
         "ON o.order_id = f.order_id WHERE f.order_id IS NULL"),
    ]
    for name, col, q in singular:
        parts.append(f"SELECT 'fact_sales' AS model, '{col}' AS column_name, '{name}' AS test_name, "
                     f"'error' AS severity, CAST(({q}) AS BIGINT) AS failures")
    body = " UNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END "
            f"AS status FROM ({body}) AS t")


def _extra_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_summary"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE ok) AS rows_loaded, "
        f"count(*) FILTER (WHERE NOT ok) AS rows_rejected FROM {cte}"
        for t, cte in _TAGGED.items()
    )
    q["rejected_by_reason"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, reason, count(*) AS rejected_rows FROM "
        f"(SELECT {_case(rs)} AS reason FROM {cte} WHERE NOT ok) AS r GROUP BY reason"
        for t, (cte, rs) in _REASONS.items()
    )
    q["validation_dry_run"] = " UNION ALL ".join(
        f"SELECT '{t}' AS feed, CASE WHEN count(*) FILTER (WHERE NOT ok) = 0 THEN 'OK' ELSE 'ISSUES FOUND' END AS status, "
        f"count(*) FILTER (WHERE ok) AS valid_rows, count(*) FILTER (WHERE NOT ok) AS invalid_rows "
        f"FROM (SELECT ({' AND '.join(c + ' IS NOT NULL' for c in cols)}) AS ok FROM {cte}) AS v"
        for t, (cte, cols) in _DRY.items()
    )
    checks = [
        ("customers", "no_duplicate_customer_id", True,
         "SELECT count(*) FROM (SELECT customer_id FROM raw_customers GROUP BY customer_id HAVING count(*) > 1)"),
        ("order_items", "positive_quantity", True, "SELECT count(*) FROM raw_order_items WHERE quantity <= 0"),
        ("order_items", "non_negative_unit_price", True, "SELECT count(*) FROM raw_order_items WHERE unit_price < 0"),
        ("order_items", "non_negative_discount", True, "SELECT count(*) FROM raw_order_items WHERE discount < 0"),
        ("order_items", "discount_not_above_line_value", True,
         "SELECT count(*) FROM raw_order_items WHERE discount > quantity * unit_price"),
        ("payments", "valid_payment_status", True,
         "SELECT count(*) FROM raw_payments WHERE payment_status NOT IN ('success', 'failed', 'pending', 'refunded')"),
        ("payments", "non_negative_amount", True, "SELECT count(*) FROM raw_payments WHERE amount < 0"),
        ("order_items", "orphan_order_items", False,
         "SELECT count(*) FROM raw_order_items oi LEFT JOIN raw_orders o ON oi.order_id = o.order_id WHERE o.order_id IS NULL"),
        ("orders", "orphan_orders_missing_customer", False,
         "SELECT count(*) FROM raw_orders o LEFT JOIN raw_customers c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL"),
    ]
    body = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS check_name, {str(c).upper()} AS critical, CAST(({s}) AS BIGINT) AS failed_rows"
        for t, n, c, s in checks
    )
    q["quality_checks"] = (
        "SELECT *, CASE WHEN failed_rows = 0 THEN 'pass' WHEN critical THEN 'fail' ELSE 'warning' END AS status "
        f"FROM ({body}) AS c"
    )
    q["model_tests"] = _model_tests_sql()
    q["dim_customer"] = "SELECT * FROM dim_customer"
    q["dim_product"] = "SELECT * FROM dim_product"
    q["dim_store"] = "SELECT * FROM dim_store"
    q["dim_date"] = "SELECT * FROM dim_date"
    q["fact_sales"] = "SELECT * FROM fact_sales"
    q["int_order_metrics"] = (
        f"SELECT order_id, item_count, CAST(total_quantity AS BIGINT) AS total_quantity, "
        f"CAST(order_subtotal AS {M}) AS order_subtotal FROM int_order_metrics"
    )
    q["int_customer_orders"] = (
        f"SELECT customer_id, total_orders, CAST(lifetime_spend AS {M}) AS lifetime_spend, first_order_date, "
        f"last_order_date FROM int_customer_orders"
    )
    q["latest_payment"] = "SELECT order_id, payment_status FROM latest_payment"
    q["narrow_calendar_fact_rows"] = """
        SELECT count(*) AS fact_rows
        FROM stg_order_items oi
        JOIN stg_orders o ON oi.order_id = o.order_id
        JOIN dim_customer dc ON o.customer_id = dc.customer_id
        JOIN dim_product dp ON oi.product_id = dp.product_id
        JOIN dim_date dd ON o.order_date = dd.full_date
        WHERE dd.full_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""
    q["products_overlay"] = """
        SELECT product_id, product_name, CAST(NULL AS VARCHAR) AS category, price, CAST(NULL AS BIGINT) AS store_id
        FROM (
          SELECT product_id, trim(product_name) AS product_name, price,
                 row_number() OVER (PARTITION BY product_id ORDER BY src DESC, seq DESC) AS rn
          FROM (
            SELECT product_id, product_name, price, 0 AS src, seq FROM feed_products
            UNION ALL
            SELECT p_partkey, p_name, CAST((CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) + 100) * 0.01 AS DECIMAL(12,2)),
                   1, p_partkey FROM part WHERE p_partkey % 10 = 0) AS u) AS w
        WHERE rn = 1 AND product_id IS NOT NULL AND product_name IS NOT NULL AND price IS NOT NULL
          AND coalesce(price >= 0, false)"""
    batch2 = """
        SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, lower(trim(email)) AS email,
               TRY_CAST(signup_date AS DATE) AS signup_date
        FROM (
          SELECT c_custkey + off AS customer_id, '  ' || split_part(c_name, '#', 1) AS first_name,
                 split_part(c_name, '#', 2) || sfx || ' ' AS last_name,
                 CASE WHEN c_custkey % 50 = 3 THEN NULL
                      ELSE ' Customer' || CAST(c_custkey + off AS VARCHAR) || '@Example.COM ' END AS email,
                 CASE WHEN c_custkey % 50 = 7 THEN 'not-a-date'
                      ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS VARCHAR) END AS signup_date
          FROM (SELECT *, 0 AS off, '-v2' AS sfx FROM customer WHERE c_custkey % 5 = 0
                UNION ALL SELECT *, 10000000 AS off, '' AS sfx FROM customer WHERE c_custkey % 25 = 1) AS b) AS t
        WHERE customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
          AND email IS NOT NULL AND signup_date IS NOT NULL"""
    q["customers_upsert"] = f"""
        , b1 AS (SELECT customer_id, first_name, last_name, email, phone,
                        'City' || CAST(customer_id % 7 AS VARCHAR) AS city, state, country, signup_date
                 FROM raw_customers),
          b2 AS ({batch2})
        SELECT * FROM b1 WHERE customer_id NOT IN (SELECT customer_id FROM b2)
        UNION ALL
        SELECT b2.customer_id, b2.first_name, b2.last_name, b2.email, b1.phone, b1.city, b1.state, b1.country,
               b2.signup_date
        FROM b2 LEFT JOIN b1 ON b2.customer_id = b1.customer_id"""
    runs = """
        , runs AS (
          SELECT event_id AS run_id,
                 CASE event_id % 3 WHEN 0 THEN 'full-pipeline' WHEN 1 THEN 'adhoc-quality-check'
                      ELSE 'incremental-orders' END AS pipeline_name,
                 CAST(ts AS TIMESTAMP) AS completed_at,
                 CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN 'success' ELSE 'failed' END AS status,
                 event_id % 1000 AS records_processed,
                 CASE WHEN event_type IN ('purchase', 'view', 'signup') AND event_id % 3 <> 1
                      THEN CAST(ts AS TIMESTAMP) END AS watermark_end
          FROM events)"""
    q["last_successful_watermark"] = runs + """
        SELECT DISTINCT ON (pipeline_name) pipeline_name, watermark_end
        FROM runs WHERE status = 'success'
        ORDER BY pipeline_name, completed_at DESC, run_id DESC"""
    q["pipeline_run_summary"] = runs + """
        SELECT pipeline_name, status, count(*) AS runs, CAST(sum(records_processed) AS BIGINT) AS records_processed,
               count(watermark_end) AS runs_with_watermark
        FROM runs GROUP BY pipeline_name, status"""
    q["incremental_orders"] = """
        SELECT order_id, customer_id, store_id, order_date, order_status
        FROM ord_tagged WHERE ok AND updated_at > TIMESTAMP '1999-01-01 00:00:00'"""
    def outcome(table: str, source: str, rules: list[tuple[str, str]]) -> str:
        return f"SELECT '{table}' AS table_name, {_case(rules)} AS reason, count(*) AS n_rows FROM {source} GROUP BY ALL"

    q["csv_customers"] = """SELECT customer_id, 'A "quoted", ' || first_name AS first_name, last_name, email, signup_date FROM raw_customers"""
    q["json_payments"] = "SELECT payment_id, order_id, amount, payment_status, payment_date FROM raw_payments"
    q["products_fallback"] = "SELECT product_id, product_name, category, price, 'csv:products.csv' AS source FROM raw_products"
    q["quoted_products"] = """
    SELECT product_id, CASE product_id % 3 WHEN 0 THEN 'big "new",' || chr(10) WHEN 1 THEN 'two' || chr(10) || chr(10) || 'lines ' ELSE '' END || product_name AS product_name,
           category, price FROM raw_products"""
    record = """'{"payment_id": "' || CASE WHEN event_id % 97 = 7 THEN 'id-' ELSE '' END || event_id || '", "order_id": "' || (event_id // 2)
      || '", "payment_status": "success", "amount": "' || (event_id % 1000) || '.50"}'"""
    q["broken_json_lines"] = q["streamed_json_lines"] = f"""
    SELECT CASE WHEN bad IS NULL THEN event_id END AS payment_id, CASE WHEN bad IS NULL THEN (event_id % 1000 + 0.5)::DECIMAL(12,2) END AS amount,
           CASE bad WHEN 'id' THEN 'null in required column payment_id' WHEN 'line' THEN 'malformed record' END AS reason, text
    FROM (SELECT event_id, CASE event_id % 97 WHEN 5 THEN 'line' WHEN 6 THEN 'line' WHEN 7 THEN 'id' END AS bad,
                 CASE event_id % 97 WHEN 5 THEN substr({record}, 1, 40) WHEN 6 THEN '# ' || event_id WHEN 7 THEN 'id-' || event_id END AS text
          FROM (SELECT DISTINCT event_id FROM events))"""
    q["two_writers"] = """
    SELECT customer_id, last_name || CASE WHEN customer_id % 6 = 0 THEN '-v2' ELSE '' END AS last_name, email,
           (customer_id % 3 + 1)::INTEGER AS created, (CASE WHEN customer_id % 6 = 0 THEN 4 ELSE customer_id % 3 + 1 END)::INTEGER AS updated
    FROM raw_customers"""
    q["appended_parts"] = "SELECT p_partkey, p_name, p_size FROM part"
    q["quality_results"] = (
        "SELECT 7::BIGINT AS pipeline_run_id, table_name, check_name, status, failed_rows, '2024-01-01 00:00:00' AS checked_at "
        f"FROM ({q['quality_checks']}) AS c"
    )
    q["reject_payloads"] = """
        SELECT order_id::VARCHAR AS order_id, f.order_date, 'null in required column order_date' AS reason
        FROM feed_orders f WHERE TRY_CAST(order_date AS DATE) IS NULL"""
    q["title_case_parts"] = """
        SELECT p_partkey, upper(p_name) AS upper,
               array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(p_name, ' ')], ' ') AS title FROM part"""
    q["numbers_from_text"] = """
        SELECT count(*) FILTER (WHERE l_orderkey % 7 <> 0) AS n_numbers,
               (sum(floor(l_extendedprice * 100 + 0.5)::BIGINT) FILTER (WHERE l_orderkey % 7 <> 0))::BIGINT AS cents,
               count(*) FILTER (WHERE l_orderkey % 5 <> 0) AS n_days,
               min(l_shipdate::DATE) FILTER (WHERE l_orderkey % 5 <> 0) AS first_day,
               max(l_shipdate::DATE) FILTER (WHERE l_orderkey % 5 <> 0) AS last_day
        FROM lineitem"""
    q["default_discount_items"] = outcome("order_items", """(
          SELECT order_id % 41 = 3 AS big, quantity, unit_price FROM (
            SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY l_partkey, l_suppkey, l_shipdate, quantity, unit_price,
                                         (discount IS NOT NULL), discount NULLS FIRST, l_tax) AS copy FROM feed_items) WHERE copy = 1)""", [
        ("NOT big AND quantity <= 0", "quantity must be greater than 0"),
        ("NOT big AND unit_price < 0", "unit_price must not be negative"),
        ("big", "quantity * unit_price is out of range"),
    ])
    q["orders_without_date"] = "SELECT 'orders' AS table_name, 'Missing required columns: [''order_date'']' AS reason, count(*) AS n_rows FROM feed_orders"
    q["stores_without_name"] = outcome("stores", "feed_stores", [("store_id % 10 = 3", "missing store_id or store_name")])
    q["invalid_order_dates"] = f"SELECT {_case([('TRY_CAST(order_date AS DATE) IS NULL', 'order_date is not a valid date')])} AS reason, count(*) AS n_rows FROM feed_orders GROUP BY ALL"
    q["duplicate_lines"] = """
        SELECT l_orderkey, 'duplicate l_orderkey' AS reason, count(*) - 1 AS n_rows
        FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem)
        GROUP BY l_orderkey HAVING count(*) > 1"""
    q["padded_calendar"] = """
        SELECT DISTINCT o_orderdate::DATE AS full_date, rpad(strftime(o_orderdate, '%B'), 9, ' ') AS month_name,
               rpad(strftime(o_orderdate, '%A'), 9, ' ') AS day_name FROM orders"""
    q["order_calendar"] = """
        SELECT strftime(full_date, '%Y%m%d')::INTEGER AS date_key, full_date, year(full_date)::INTEGER AS year,
               quarter(full_date)::INTEGER AS quarter, month(full_date)::INTEGER AS month, strftime(full_date, '%B') AS month_name,
               day(full_date)::INTEGER AS day, (isodow(full_date) - 1)::INTEGER AS day_of_week, strftime(full_date, '%A') AS day_name,
               isodow(full_date) > 5 AS is_weekend
        FROM (SELECT unnest(generate_series(make_date(min(year(order_date)), 1, 1), make_date(max(year(order_date)), 12, 31), INTERVAL 1 DAY))::DATE AS full_date
              FROM raw_orders)"""
    q["pipeline_outcome"] = f"""
        SELECT 'full-pipeline' AS pipeline_name, CASE WHEN (SELECT count(*) FROM ({q['model_tests']}) WHERE status = 'fail') > 0 THEN 'failed' ELSE 'success' END AS status,
               ({' + '.join(f'(SELECT count(*) FROM {cte} WHERE ok)' for cte in _TAGGED.values())})::BIGINT AS records_processed,
               '2024-01-01 00:00:00' AS started_at, '2024-01-01 00:00:00' AS watermark_end"""
    q["streamed_orders"] = "SELECT order_id, customer_id, store_id, order_date, order_status FROM raw_orders"
    return q


def oracle_queries_all() -> dict[str, str]:
    out = oracle_queries()
    for k, v in _extra_sql().items():
        out[k] = BASE + v
    return out
