"""Feed and bronze table declarations.

A feed column is ``(name, spark type, required)``. ``required`` columns must be
present in the batch (else the whole batch is rejected) and non-null per row.
Types are enforced with ``try_cast``: a value that does not parse becomes null
and, for a required column, rejects the row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = "decimal(12,2)"
LINE_MONEY = "decimal(18,2)"
# quantity x price for any integer quantity and any MONEY price
WIDE_MONEY = "decimal(26,2)"
SUM_MONEY = "decimal(38,2)"


@dataclass(frozen=True)
class Col:
    name: str
    dtype: str
    required: bool = True


@dataclass(frozen=True)
class TableSpec:
    name: str
    pk: tuple[str, ...]
    columns: tuple[Col, ...]
    trim: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)

    @property
    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, _parse(c.dtype), not c.required) for c in self.columns]
        )

    def feed_struct(self) -> T.StructType:
        """All-string schema used to read a CSV feed without inference."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])


def _parse(dtype: str) -> T.DataType:
    return T._parse_datatype_string(dtype)


CUSTOMERS = TableSpec(
    "customers",
    ("customer_id",),
    (
        Col("customer_id", "bigint"),
        Col("first_name", "string"),
        Col("last_name", "string"),
        Col("email", "string"),
        Col("phone", "string", False),
        Col("city", "string", False),
        Col("state", "string", False),
        Col("country", "string", False),
        Col("signup_date", "date"),
    ),
    trim=("first_name", "last_name", "city", "state", "country"),
    lower=("email",),
)

STORES = TableSpec(
    "stores",
    ("store_id",),
    (
        Col("store_id", "bigint"),
        Col("store_name", "string"),
        Col("city", "string", False),
        Col("state", "string", False),
        Col("country", "string", False),
    ),
    trim=("store_name", "city", "state", "country"),
)

PRODUCTS = TableSpec(
    "products",
    ("product_id",),
    (
        Col("product_id", "bigint"),
        Col("product_name", "string"),
        Col("category", "string", False),
        Col("price", MONEY),
        Col("store_id", "bigint", False),
    ),
    trim=("product_name", "category"),
)

ORDERS = TableSpec(
    "orders",
    ("order_id",),
    (
        Col("order_id", "bigint"),
        Col("customer_id", "bigint"),
        Col("store_id", "bigint", False),
        Col("order_date", "date"),
        Col("order_status", "string", False),
    ),
    trim=("order_status",),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    ("order_item_id",),
    (
        Col("order_item_id", "bigint"),
        Col("order_id", "bigint"),
        Col("product_id", "bigint"),
        Col("quantity", "int"),
        Col("unit_price", MONEY),
        Col("discount", MONEY, False),
    ),
)

PAYMENTS = TableSpec(
    "payments",
    ("payment_id",),
    (
        Col("payment_id", "bigint"),
        Col("order_id", "bigint"),
        Col("payment_method", "string", False),
        Col("amount", MONEY),
        Col("payment_status", "string"),
        Col("payment_date", "date", False),
    ),
    trim=("payment_method", "payment_status"),
)

SPECS: dict[str, TableSpec] = {
    s.name: s for s in (CUSTOMERS, STORES, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)
}

# Fixed values that must equal the reference: accepted statuses.
VALID_PAYMENT_STATUSES = ("success", "failed", "pending", "refunded")
