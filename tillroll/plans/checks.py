"""Raw-layer quality checks and the gate (Q-1 ... Q-10).

The reference runs nine separate count queries. Here the row-level checks of
a table are folded into ONE aggregate (one scan per table), unpivoted with
``stack``; the duplicate-key and orphan checks are one aggregate / anti join
each. The result is a small DataFrame of (table, check, critical,
failed_rows, status); the gate reads its nine rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import sized
from tillroll.schemas import VALID_PAYMENT_STATUSES

Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class QualityCheck:
    table_name: str
    check_name: str
    critical: bool = True


# Fixed values that must equal the reference's check names, tables and severities.
RAW_LAYER_CHECKS = (
    QualityCheck("customers", "no_duplicate_customer_id"),
    QualityCheck("order_items", "positive_quantity"),
    QualityCheck("order_items", "non_negative_unit_price"),
    QualityCheck("order_items", "non_negative_discount"),
    QualityCheck("order_items", "discount_not_above_line_value"),
    QualityCheck("payments", "valid_payment_status"),
    QualityCheck("payments", "non_negative_amount"),
    QualityCheck("order_items", "orphan_order_items", critical=False),
    QualityCheck("orders", "orphan_orders_missing_customer", critical=False),
)


def _stack(df: DataFrame, table: str, names: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df.selectExpr(f"'{table}' AS table_name", f"stack({len(names)}, {pairs}) AS (check_name, failed_rows)")


def _anti_count(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    # anti join: duplicates in the parent do not change the result
    return child.select(key).join(sized(parent.select(key)), key, "left_anti").agg(F.count(F.lit(1)).alias(name))


def failing_rows(read_raw: Reader) -> DataFrame:
    """(table_name, check_name, failed_rows) for every raw-layer check."""
    items = read_raw("order_items")
    payments = read_raw("payments")
    customers = read_raw("customers")
    orders = read_raw("orders")
    item_counts = items.agg(
        F.count_if(F.col("quantity") <= 0).alias("positive_quantity"),
        F.count_if(F.col("unit_price") < 0).alias("non_negative_unit_price"),
        F.count_if(F.col("discount") < 0).alias("non_negative_discount"),
        F.count_if(F.col("discount") > F.col("quantity") * F.col("unit_price")).alias("discount_not_above_line_value"),
    )
    pay_counts = payments.agg(
        # NOT IN is three-valued: a null status is not counted
        F.count_if(~F.col("payment_status").isin(*VALID_PAYMENT_STATUSES)).alias("valid_payment_status"),
        F.count_if(F.col("amount") < 0).alias("non_negative_amount"),
    )
    dup = (
        customers.groupBy("customer_id").count().filter(F.col("count") > 1)
        .agg(F.count(F.lit(1)).alias("no_duplicate_customer_id"))
    )
    parts = [
        _stack(dup, "customers", ["no_duplicate_customer_id"]),
        _stack(item_counts, "order_items", [
            "positive_quantity", "non_negative_unit_price", "non_negative_discount", "discount_not_above_line_value",
        ]),
        _stack(pay_counts, "payments", ["valid_payment_status", "non_negative_amount"]),
        _stack(_anti_count(items, orders, "order_id", "orphan_order_items"), "order_items", ["orphan_order_items"]),
        _stack(_anti_count(orders, customers, "customer_id", "orphan_orders_missing_customer"), "orders",
               ["orphan_orders_missing_customer"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("failed_rows", F.col("failed_rows").cast("long"))


def quality_checks(read_raw: Reader, checks=RAW_LAYER_CHECKS) -> DataFrame:
    """Q-10: result rows with status pass / fail (critical) / warning."""
    spark = read_raw("customers").sparkSession
    meta = spark.createDataFrame(
        [(c.table_name, c.check_name, c.critical) for c in checks],
        "table_name string, check_name string, critical boolean",
    )
    res = failing_rows(read_raw).join(F.broadcast(meta), ["table_name", "check_name"])
    status = (
        F.when(F.col("failed_rows") == 0, F.lit("pass"))
        .when(F.col("critical"), F.lit("fail"))
        .otherwise(F.lit("warning"))
    )
    return res.select("table_name", "check_name", "critical", "failed_rows", status.alias("status"))


def gate_passed(results: DataFrame) -> bool:
    """True iff no critical check failed (reads the handful of result rows)."""
    return results.filter(F.col("status") == "fail").limit(1).count() == 0
