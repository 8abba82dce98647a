"""Staging views over the bronze tables (P-9 ... P-14): 1:1, no joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Reader = Callable[[str], DataFrame]


# staging model -> columns as SQL, the one definition of the frames and of the
# catalog's views
MODELS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "trim(first_name) AS first_name", "trim(last_name) AS last_name", "lower(trim(email)) AS email",
        "phone", "city", "state", "country", "signup_date", "created_at", "updated_at",
    ],
    "products": [
        "product_id", "trim(product_name) AS product_name", "coalesce(trim(category), 'Uncategorized') AS category",
        "price", "store_id", "created_at", "updated_at",
    ],
    "stores": ["store_id", "trim(store_name) AS store_name", "city", "state", "country", "created_at", "updated_at"],
    "orders": [
        "order_id", "customer_id", "store_id", "order_date", "coalesce(order_status, 'unknown') AS order_status",
        "created_at", "updated_at",
    ],
    "order_items": [
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        "coalesce(discount, cast(0 AS decimal(12,2))) AS discount", "created_at", "updated_at",
    ],
    "payments": [
        "payment_id", "order_id", "payment_method", "amount", "payment_status", "payment_date", "created_at", "updated_at",
    ],
}


def stage(name: str, raw: DataFrame) -> DataFrame:
    """The staging model over a bronze table."""
    return raw.selectExpr(*MODELS[name])


def view_sql(name: str, source: str) -> str:
    return f"SELECT {', '.join(MODELS[name])} FROM {source}"


def staging(read_raw: Reader) -> dict[str, DataFrame]:
    """All staging views, keyed by source table name (lazy)."""
    return {name: stage(name, read_raw(name)) for name in MODELS}
