"""Star schema (M-1 ... M-7): four dimensions around a sales fact at
order-line grain, plus the two intermediate per-order/per-customer models.

Join order for the fact: every per-order lookup (customer, calendar, store,
latest payment) is joined to ``orders`` first, at order grain, and the
result is joined once to the order lines. Dimensions are broadcast only
behind a row-count check; the payment lookup and the line join are shuffle
joins on ``order_id`` that share one partitioning of the order side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.calendar import calendar_attributes, utc
from tillroll.functions.coerce import line_total
from tillroll.operators.joins import dim_join
from tillroll.operators.keys import dense_key
from tillroll.operators.latest import desc_nulls_last, latest_per_group

# Fixed value: the default range of a calendar that is generated on its own
REFERENCE_CALENDAR = (dt.date(2023, 1, 1), dt.date(2027, 12, 31))


_now = utc


def dim_customer(stg_customers: DataFrame, run_ts: dt.datetime, num_partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    base = stg_customers.select(
        "customer_id", "first_name", "last_name", "email", "city", "state", "country", "signup_date"
    )
    keyed = dense_key(base, ["customer_id"], "customer_key", num_partitions, scratch=scratch)
    return keyed.withColumns({"created_at": _now(run_ts), "updated_at": _now(run_ts)})


def dim_product(stg_products: DataFrame, run_ts: dt.datetime, num_partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    base = stg_products.select("product_id", "product_name", "category", "price")
    keyed = dense_key(base, ["product_id"], "product_key", num_partitions, scratch=scratch)
    return keyed.withColumns({"created_at": _now(run_ts), "updated_at": _now(run_ts)})


def dim_store(stg_stores: DataFrame, run_ts: dt.datetime, num_partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    base = stg_stores.select("store_id", "store_name", "city", "state", "country")
    keyed = dense_key(base, ["store_id"], "store_key", num_partitions, scratch=scratch)
    return keyed.withColumns({"created_at": _now(run_ts), "updated_at": _now(run_ts)})


def dim_date(
    spark: SparkSession,
    start: dt.date = REFERENCE_CALENDAR[0],
    end: dt.date = REFERENCE_CALENDAR[1],
    pad_names: bool = False,
) -> DataFrame:
    """Calendar spine start..end inclusive, generated distributed with range()."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(0, days).select(
        *[c.alias(n) for n, c in calendar_attributes(d, pad_names).items()]
    )


def dim_date_of(rows: DataFrame, column: str, pad_names: bool = False) -> DataFrame:
    """Calendar of the whole years between the smallest and the largest date of a
    column; no days where it holds none."""
    years = rows.agg(F.trunc(F.min(column), "year").alias("a"), F.last_day(F.add_months(F.trunc(F.max(column), "year"), 11)).alias("b"))
    days = years.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("d"))
    return days.select(*[c.alias(n) for n, c in calendar_attributes(F.col("d"), pad_names).items()])


def latest_payment(stg_payments: DataFrame) -> DataFrame:
    """W-3: per order the status of the latest attempt
    (payment_date desc nulls last, payment_id desc)."""
    return latest_per_group(
        stg_payments,
        ["order_id"],
        ["payment_status"],
        [*desc_nulls_last("payment_date"), F.col("payment_id")],
    )


def fact_lines(
    stg: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    run_ts: dt.datetime,
) -> DataFrame:
    """Fact rows before the sale_id numbering (J-1 ... J-6)."""
    orders = stg["orders"].select("order_id", "customer_id", "store_id", "order_date")
    dc = dims["customer"].select("customer_id", "customer_key")
    dd = dims["date"].select(F.col("full_date").alias("order_date"), "date_key")
    ds = dims["store"].select("store_id", "store_key")
    dp = dims["product"].select("product_id", "product_key")
    # merged in place whatever its estimate: one row an order is no dimension
    lp = latest_payment(stg["payments"]).hint("merge")

    octx = dim_join(orders, dc, "customer_id")
    octx = dim_join(octx, dd, "order_date")
    octx = dim_join(octx, ds, "store_id", "left")
    octx = octx.join(lp, "order_id", "left").select(
        "order_id", "customer_key", "store_key", "date_key", "payment_status"
    )
    items = stg["order_items"].select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount"
    )
    items = dim_join(items, dp, "product_id")
    lines = items.join(octx, "order_id")
    return lines.select(
        F.col("order_item_id"),
        F.col("order_id"),
        "customer_key",
        "product_key",
        "store_key",
        "date_key",
        "quantity",
        "unit_price",
        "discount",
        F.lit(0).cast("decimal(12,2)").alias("tax"),
        line_total("quantity", "unit_price", "discount").alias("total_amount"),
        F.coalesce(F.col("payment_status"), F.lit("pending")).alias("payment_status"),
        _now(run_ts).alias("created_at"),
    )


def fact_sales(lines: DataFrame, num_partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    """M-5: number the lines by (order_id, order_item_id) -> sale_id."""
    return dense_key(lines, ["order_id", "order_item_id"], "sale_id", num_partitions, scratch=scratch)


def int_order_metrics(stg_order_items: DataFrame) -> DataFrame:
    """M-6 / A-5: per order item count, units and subtotal."""
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.sum(line_total("quantity", "unit_price", "discount")).cast("decimal(38,2)").alias("order_subtotal"),
    )


def int_customer_orders(stg_orders: DataFrame, order_metrics: DataFrame) -> DataFrame:
    """M-7 / A-6: per customer with at least one order (J-7: inner join)."""
    o = stg_orders.select("order_id", "customer_id", "order_date")
    j = o.join(order_metrics.select("order_id", "order_subtotal"), "order_id")
    return j.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("order_subtotal").cast("decimal(38,2)").alias("lifetime_spend"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
