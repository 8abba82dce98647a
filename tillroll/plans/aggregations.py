"""DataFrame-level revenue functions over order lines (R-24 ... R-27).

They take bronze-shaped DataFrames directly (no star schema), so they keep
orphan lines that the fact drops. A missing discount column counts as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.coerce import line_total
from tillroll.operators.joins import sized
from tillroll.schemas import SUM_MONEY


def _lines(order_items: DataFrame, *keep: str) -> DataFrame:
    disc = "discount" if "discount" in order_items.columns else None
    return order_items.select(*keep, line_total("quantity", "unit_price", disc).alias("line_total"))


def total_revenue(order_items: DataFrame) -> DataFrame:
    """Σ (quantity * unit_price - discount); 0 for no lines."""
    return _lines(order_items).agg(F.coalesce(F.sum("line_total"), F.lit(0)).cast(SUM_MONEY).alias("total_revenue"))


def revenue_by_date(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Daily revenue by order_date (lines without an order or a date drop)."""
    j = _lines(order_items, "order_id").join(orders.select("order_id", "order_date"), "order_id")
    j = j.filter(F.col("order_date").isNotNull())
    return j.groupBy("order_date").agg(F.sum("line_total").cast(SUM_MONEY).alias("revenue")).orderBy("order_date")


def top_n_products(order_items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` product names by revenue (same-named products merge).

    Lines are first summed per product_id (map-side combined), so the join
    carries one row per product per task; the catalog is broadcast only when
    proven small.
    """
    names = products.select("product_id", "product_name")
    per_product = _lines(order_items, "product_id").groupBy("product_id").agg(F.sum("line_total").alias("_r"))
    j = per_product.join(sized(names), "product_id")
    r = j.groupBy("product_name").agg(F.sum("_r").cast(SUM_MONEY).alias("revenue"))
    return r.orderBy(F.desc("revenue"), "product_name").limit(n)


def average_order_value(order_items: DataFrame) -> DataFrame:
    """Revenue / distinct orders; 0.0 when there are no orders."""
    f = _lines(order_items, "order_id").agg(F.sum("line_total").alias("s"), F.count_distinct("order_id").alias("n"))
    return f.select(
        F.when(F.col("n") == 0, F.lit(0.0)).otherwise(F.col("s").cast("double") / F.col("n")).alias("average_order_value")
    )
