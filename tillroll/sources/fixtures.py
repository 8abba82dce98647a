"""Feed projections over the driver's TPC-H-style tables.

The reference ingests six feeds (customers, stores, products, orders,
order_items, payments) with planted defects. These projections derive the
same feeds, defects included, from the given tables, so every job scales with
them. Money goes through integer cents so Spark and the SQL oracle agree to
the cent. Each feed carries ``_seq``, the order that defines "first copy"
for keep-first de-duplication.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.joins import dim_join

SEQ = "_seq"
def _cent():
    return F.lit(Decimal("0.01"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_from_cents(cents: Column) -> Column:
    # decimal(15,0) x decimal(2,2) = decimal(18,2): stays on Spark's long-backed
    # decimal path (a bigint operand would make it decimal(23,2), BigDecimal)
    return (cents.cast("decimal(15,0)") * _cent()).cast("decimal(12,2)")


def _cents(x: Column) -> Column:
    # Half-up to whole cents with double arithmetic (no per-row BigDecimal);
    # the inputs carry two decimals, so x * 100 is within 1e-6 of an integer.
    return F.floor(x * 100 + 0.5).cast("long")


def _iso_date(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def customers_feed(
    spark: SparkSession,
    sf_dir: str,
    where: Column | None = None,
    id_offset: int = 0,
    last_name_suffix: str = "",
    with_city: bool = False,
) -> DataFrame:
    """Customers feed; the extra arguments shape later batches for upsert tests."""
    c = table(spark, sf_dir, "customer")
    if where is not None:
        c = c.filter(where)
    k = F.col("c_custkey")
    cid = k + F.lit(id_offset) if id_offset else k
    cols = [
        cid.alias("customer_id"),
        F.concat(F.lit("  "), F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
        F.concat(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit(last_name_suffix + " ")).alias("last_name"),
        F.when(k % 50 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" Customer"), cid.cast("string"), F.lit("@Example.COM ")))
        .alias("email"),
        F.when(k % 50 == 7, F.lit("not-a-date"))
        .otherwise(F.date_add(F.lit("1995-01-01").cast("date"), (k % 2000).cast("int")).cast("string"))
        .alias("signup_date"),
    ]
    if with_city:
        cols.append(F.concat(F.lit("City"), (cid % 7).cast("string")).alias("city"))
    return c.select(*cols, F.struct(cid.alias("c_custkey")).alias(SEQ))


def stores_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = dim_join(n, r, n.n_regionkey == r.r_regionkey)
    joined = dim_join(s, geo, s.s_nationkey == geo.n_nationkey)
    return joined.select(
        F.col("s_suppkey").alias("store_id"),
        F.concat(F.lit(" "), F.col("s_name")).alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.struct(F.col("s_suppkey")).alias(SEQ),
    )


def products_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = _money_from_cents(_cents(F.col("p_retailprice")))
    return p.select(
        k.alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("product_name"),
        F.when(k % 9 == 4, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.when(k % 50 == 1, -price).otherwise(price).alias("price"),
        F.struct(k).alias(SEQ),
    )


def products_api_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API extract for the overlay (S-3): every tenth part, price + 1."""
    p = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 10 == 0)
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        _money_from_cents(_cents(F.col("p_retailprice")) + 100).alias("price"),
        F.struct(F.col("p_partkey")).alias(SEQ),
    )


_STATUS = {"O": "placed", "F": "delivered"}


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "O", F.lit(_STATUS["O"])).when(
        F.col("o_orderstatus") == "F", F.lit(_STATUS["F"])
    )
    return o.select(
        k.alias("order_id"),
        F.when(k % 97 == 5, F.lit(-1).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(k % 13 == 0, F.lit(None).cast("long")).otherwise(k % 12).alias("store_id"),
        F.when(k % 50 == 11, F.lit("31-31-2026")).otherwise(_iso_date(F.col("o_orderdate"))).alias("order_date"),
        status.alias("order_status"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.struct(k).alias(SEQ),
    )


def order_items_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    q = F.col("l_quantity").cast("int")
    cents = "cast(floor(l_extendedprice * 100 + 0.5) as bigint)"
    pct = "cast(floor(l_discount * 100 + 0.5) as bigint)"
    unit = _money_from_cents(F.expr(f"{cents} div cast(l_quantity as int)"))
    disc = _money_from_cents(F.expr(f"({cents} * {pct}) div 100"))
    quantity = F.when(k % 53 == 7, -q).otherwise(q)
    unit_price = F.when(k % 59 == 9, -unit).otherwise(unit)
    discount = F.when(k % 61 == 4, F.lit(None).cast("decimal(12,2)")).otherwise(disc)
    items = li.select(
        (k * 10 + F.col("l_linenumber")).alias("order_item_id"),
        k.alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        discount.alias("discount"),
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_tax",
    )
    seq = F.struct(
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "quantity",
        "unit_price",
        F.col("discount").isNotNull().alias("has_discount"),
        "discount",
        "l_tax",
    )
    return items.withColumn(SEQ, seq).drop("l_partkey", "l_suppkey", "l_shipdate", "l_tax")


_PAYMENT_STATUS = {
    "purchase": "success",
    "error": "failed",
    "view": "pending",
    "signup": "refunded",
    "click": "unknown_status",
}


def payments_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    status = None
    for src, dst in _PAYMENT_STATUS.items():
        cond = F.col("event_type") == src
        status = F.when(cond, F.lit(dst)) if status is None else status.when(cond, F.lit(dst))
    amount = _money_from_cents(_cents(F.col("value")))
    return e.select(
        k.alias("payment_id"),
        F.expr("event_id div 2").alias("order_id"),
        status.alias("payment_status"),
        F.when(k % 50 == 1, -amount).otherwise(amount).alias("amount"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(_iso_date(F.col("ts"))).alias("payment_date"),
        F.struct(k).alias(SEQ),
    )


FEEDS = {
    "customers": customers_feed,
    "stores": stores_feed,
    "products": products_feed,
    "orders": orders_feed,
    "order_items": order_items_feed,
    "payments": payments_feed,
}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FEEDS[name](spark, sf_dir)
