"""Reporting queries (R-1 ... R-27) over the star schema and bronze tables.

Fact-by-dimension reports go through ``rollup_by_dim``: when the dimension is
proven small it is broadcast and the aggregate is combined map-side, so the
only shuffle carries one row per group per task; when it is not, the fact is
first collapsed to the join key (or key x order for distinct-order counts) so
the shuffle into the join carries partial sums, not lines. Top-k keeps a
tie-break on the group key so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.calendar import month_start
from tillroll.operators.joins import fits_broadcast
from tillroll.plans import aggregations
from tillroll.plans.warehouse import Warehouse
from tillroll.schemas import SUM_MONEY


def _money(c: Column) -> Column:
    return c.cast(SUM_MONEY)


def rollup_by_dim(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    attrs: Sequence[str],
    money: str | None = None,
    units: str | None = None,
    orders: str | None = None,
    lines: str | None = None,
) -> DataFrame:
    """Group fact measures by dimension attributes reached through ``key``.

    ``money``: Σ total_amount, ``units``: Σ quantity, ``orders``: count of
    distinct order_id, ``lines``: count of fact rows; each names its output.
    """
    d = dim.select(key, *attrs)
    if fits_broadcast(d):
        j = fact.join(F.broadcast(d), key)
        aggs = []
        if money:
            aggs.append(_money(F.sum("total_amount")).alias(money))
        if units:
            aggs.append(F.sum("quantity").cast("long").alias(units))
        if orders:
            aggs.append(F.count_distinct("order_id").alias(orders))
        if lines:
            aggs.append(F.count(F.lit(1)).alias(lines))
        return j.groupBy(*attrs).agg(*aggs)
    grain = [key, "order_id"] if orders else [key]
    pre = fact.groupBy(*grain).agg(
        F.sum("total_amount").alias("_m"),
        F.sum("quantity").cast("long").alias("_u"),
        F.count(F.lit(1)).alias("_n"),
    )
    j = pre.join(d.hint("merge"), key)
    aggs = []
    if money:
        aggs.append(_money(F.sum("_m")).alias(money))
    if units:
        aggs.append(F.sum("_u").cast("long").alias(units))
    if orders:
        aggs.append(F.count_distinct("order_id").alias(orders))
    if lines:
        aggs.append(F.sum("_n").cast("long").alias(lines))
    return j.groupBy(*attrs).agg(*aggs)


# ---- revenue (sql/analytics revenue) -------------------------------------

def total_revenue(wh: Warehouse) -> DataFrame:
    return wh.fact.agg(_money(F.sum("total_amount")).alias("total_revenue"))


def daily_revenue(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(wh.fact, wh.dim("date"), "date_key", ["full_date"], money="daily_revenue", orders="order_count")
    return r.orderBy("full_date")


def monthly_revenue(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(wh.fact, wh.dim("date"), "date_key", ["year", "month", "month_name"], money="monthly_revenue")
    return r.orderBy("year", "month")


def average_order_value(wh: Warehouse) -> DataFrame:
    f = wh.fact.agg(F.sum("total_amount").alias("s"), F.count_distinct("order_id").alias("n"))
    return f.select((F.col("s").cast("double") / F.nullif(F.col("n"), F.lit(0))).alias("average_order_value"))


def revenue_by_category(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(wh.fact, wh.dim("product"), "product_key", ["category"], money="category_revenue")
    return r.orderBy(F.desc("category_revenue"), "category")


# ---- customers -------------------------------------------------------------

def top_customers_ltv(wh: Warehouse, n: int = 10) -> DataFrame:
    r = rollup_by_dim(
        wh.fact, wh.dim("customer"), "customer_key", ["customer_id", "first_name", "last_name"],
        money="lifetime_spend", orders="total_orders",
    )
    return r.orderBy(F.desc("lifetime_spend"), "customer_id").limit(n)


def new_customers_by_month(wh: Warehouse) -> DataFrame:
    c = wh.dim("customer").filter(F.col("signup_date").isNotNull())
    r = c.groupBy(month_start(F.col("signup_date")).alias("signup_month")).agg(F.count(F.lit(1)).alias("new_customers"))
    return r.orderBy("signup_month")


def repeat_customer_rate(wh: Warehouse) -> DataFrame:
    per = wh.fact.groupBy("customer_key").agg(F.count_distinct("order_id").alias("order_count"))
    return per.agg(
        (F.count_if(F.col("order_count") > 1).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(
            "repeat_customer_rate"
        )
    )


# ---- products ----------------------------------------------------------------

def top_products(wh: Warehouse, n: int = 10) -> DataFrame:
    r = rollup_by_dim(
        wh.fact, wh.dim("product"), "product_key", ["product_id", "product_name", "category"],
        money="product_revenue", units="units_sold",
    )
    return r.orderBy(F.desc("product_revenue"), "product_id").limit(n)


def category_performance(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(
        wh.fact, wh.dim("product"), "product_key", ["category"],
        money="category_revenue", units="units_sold", orders="orders_containing_category",
    )
    return r.orderBy(F.desc("category_revenue"), "category")


# ---- sales / payments / stores -----------------------------------------------

def payment_status_share(wh: Warehouse) -> DataFrame:
    # The window runs over the aggregated rows: one per payment status.
    counts = wh.fact.groupBy("payment_status").agg(F.count(F.lit(1)).alias("line_items"))
    total = F.sum("line_items").over(Window.partitionBy())
    return counts.select(
        "payment_status",
        "line_items",
        F.round(F.lit(100.0) * F.col("line_items").cast("double") / total, 2).alias("pct_of_total"),
    ).orderBy(F.desc("line_items"), "payment_status")


def sales_by_store(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(
        wh.fact, wh.dim("store"), "store_key", ["store_id", "store_name", "city"],
        money="store_revenue", orders="orders_fulfilled",
    )
    return r.orderBy(F.desc("store_revenue"), "store_id")


def weekday_weekend(wh: Warehouse) -> DataFrame:
    return rollup_by_dim(wh.fact, wh.dim("date"), "date_key", ["is_weekend"], money="revenue", orders="order_count")


# ---- dashboard -----------------------------------------------------------------

def dash_total_revenue(wh: Warehouse) -> DataFrame:
    return wh.fact.agg(_money(F.coalesce(F.sum("total_amount"), F.lit(0))).alias("total_revenue"))


def dash_total_orders(wh: Warehouse) -> DataFrame:
    return wh.fact.agg(F.count_distinct("order_id").alias("total_orders"))


def dash_total_customers(wh: Warehouse) -> DataFrame:
    return wh.dim("customer").agg(F.count(F.lit(1)).alias("total_customers"))


def dash_aov(wh: Warehouse) -> DataFrame:
    f = wh.fact.agg(F.sum("total_amount").alias("s"), F.count_distinct("order_id").alias("n"))
    ratio = F.col("s").cast("double") / F.nullif(F.col("n"), F.lit(0))
    return f.select(F.coalesce(ratio, F.lit(0.0)).alias("aov"))


def dash_revenue_by_date(wh: Warehouse) -> DataFrame:
    return rollup_by_dim(wh.fact, wh.dim("date"), "date_key", ["full_date"], money="revenue").orderBy("full_date")


def dash_revenue_by_category(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(wh.fact, wh.dim("product"), "product_key", ["category"], money="revenue")
    return r.orderBy(F.desc("revenue"), "category")


def dash_top_products(wh: Warehouse, n: int = 10) -> DataFrame:
    r = rollup_by_dim(wh.fact, wh.dim("product"), "product_key", ["product_name"], money="revenue")
    return r.orderBy(F.desc("revenue"), "product_name").limit(n)


def dash_top_customers(wh: Warehouse, n: int = 10) -> DataFrame:
    cust = wh.dim("customer").select(
        "customer_key", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name")
    )
    r = rollup_by_dim(wh.fact, cust, "customer_key", ["customer_name"], money="revenue")
    return r.orderBy(F.desc("revenue"), "customer_name").limit(n)


def dash_payment_status(wh: Warehouse) -> DataFrame:
    return wh.fact.groupBy("payment_status").agg(F.count(F.lit(1)).alias("line_items"))


def dash_sales_by_store(wh: Warehouse) -> DataFrame:
    r = rollup_by_dim(wh.fact, wh.dim("store"), "store_key", ["store_name"], money="revenue")
    return r.orderBy(F.desc("revenue"), "store_name")


# ---- DataFrame aggregations over bronze rows (R-24 ... R-27) --------------------

def raw_total_revenue(wh: Warehouse) -> DataFrame:
    return aggregations.total_revenue(wh.raw("order_items"))


def raw_revenue_by_date(wh: Warehouse) -> DataFrame:
    return aggregations.revenue_by_date(wh.raw("order_items"), wh.raw("orders"))


def raw_top_products(wh: Warehouse, n: int = 10) -> DataFrame:
    return aggregations.top_n_products(wh.raw("order_items"), wh.raw("products"), n)


def raw_average_order_value(wh: Warehouse) -> DataFrame:
    return aggregations.average_order_value(wh.raw("order_items"))


REPORTS = {
    "total_revenue": total_revenue,
    "daily_revenue": daily_revenue,
    "monthly_revenue": monthly_revenue,
    "average_order_value": average_order_value,
    "revenue_by_category": revenue_by_category,
    "top_customers_ltv": top_customers_ltv,
    "new_customers_by_month": new_customers_by_month,
    "repeat_customer_rate": repeat_customer_rate,
    "top_products": top_products,
    "category_performance": category_performance,
    "payment_status_share": payment_status_share,
    "sales_by_store": sales_by_store,
    "weekday_weekend": weekday_weekend,
    "dash_total_revenue": dash_total_revenue,
    "dash_total_orders": dash_total_orders,
    "dash_total_customers": dash_total_customers,
    "dash_aov": dash_aov,
    "dash_revenue_by_date": dash_revenue_by_date,
    "dash_revenue_by_category": dash_revenue_by_category,
    "dash_top_products": dash_top_products,
    "dash_top_customers": dash_top_customers,
    "dash_payment_status": dash_payment_status,
    "dash_sales_by_store": dash_sales_by_store,
    "raw_total_revenue": raw_total_revenue,
    "raw_revenue_by_date": raw_revenue_by_date,
    "raw_top_products": raw_top_products,
    "raw_average_order_value": raw_average_order_value,
}
