"""Registered queries of readers, store operations, rules and cleaning that the
reports don't reach. Each works on feeds projected from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.calendar import calendar_attributes
from tillroll.functions.coerce import coerce_numeric, parse_date
from tillroll.functions.text import standardize_text_case
from tillroll.operators import rules as R
from tillroll.plans import checks, ingest, ledger, marts
from tillroll.plans.warehouse import open_warehouse
from tillroll.schemas import SPECS
from tillroll.session import scratch_dir
from tillroll.sources import audit, fixtures
from tillroll.sources.files import load_csv, load_json
from tillroll.sources.fixtures import SEQ, table
from tillroll.sources.overlay import products_input
from tillroll.sources.tables import TableStore

RUN_TS = dt.datetime(2024, 1, 1)


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string") for c in df.columns if c != SEQ])


def _outcome(tagged: DataFrame, name: str) -> DataFrame:
    """Rows per first failed rule (null: valid)."""
    return tagged.groupBy(F.lit(name).alias("table_name"), F.col(R.REASON).alias("reason")).agg(F.count("*").alias("n_rows"))


def csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: the customers feed, landed as CSV with quotes and commas in text, then
    read, cleaned and validated."""
    feed = _text(fixtures.customers_feed(spark, sf_dir))
    feed = feed.withColumn("first_name", F.concat(F.lit('A "quoted", '), F.trim("first_name")))
    path = scratch_dir(spark, "csv")
    feed.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    loaded = load_csv(spark, path, SPECS["customers"].required_columns)
    return ingest.prepare(loaded, "customers").where(R.is_valid()).select("customer_id", "first_name", "last_name", "email", "signup_date")


def json_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2: the payments feed, landed as JSON Lines and read as text (P-5 from text)."""
    path = scratch_dir(spark, "json")
    _text(fixtures.payments_feed(spark, sf_dir)).write.json(path)
    loaded = load_json(spark, path, lines=True, schema=SPECS["payments"].feed_struct())
    return ingest.prepare(loaded, "payments").where(R.is_valid()).select("payment_id", "order_id", "amount", "payment_status", "payment_date")


def quoted_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: product names with commas, quotes and line ends inside quoted fields; such
    files are read in splits."""
    path = scratch_dir(spark, "quoted")
    k = F.col("product_id").cast("long")
    lead = F.when(k % 3 == 0, F.lit('big "new",\n')).when(k % 3 == 1, F.lit("two\n\nlines ")).otherwise(F.lit(""))
    feed = _text(fixtures.products_feed(spark, sf_dir)).withColumn("product_name", F.concat(lead, "product_name"))
    feed.write.option("header", True).option("escape", '"').csv(path)
    loaded = load_csv(spark, path, SPECS["products"].required_columns)
    return ingest.prepare(loaded, "products").where(R.is_valid()).select("product_id", "product_name", "category", "price")


def _payment_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land payments as JSON Lines; some lines are cut off, some are no JSON, and some
    ids are no numbers."""
    k = F.col("event_id")
    record = F.concat(F.lit('{"payment_id": "'), F.when(k % 97 == 7, F.lit("id-")).otherwise(F.lit("")), k.cast("string"), F.lit('", "order_id": "'),
                      F.expr("event_id div 2").cast("string"), F.lit('", "payment_status": "success", "amount": "'), (k % 1000).cast("string"), F.lit('.50"}'))
    line = F.when(k % 97 == 5, F.substring(record, 1, 40)).when(k % 97 == 6, F.concat(F.lit("# "), k.cast("string"))).otherwise(record)
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)


def _loaded_and_rejected(valid: DataFrame, rejects: DataFrame) -> DataFrame:
    """Loaded payments, and of rejects the reason with the line's text or the bad id."""
    text = F.coalesce(F.get_json_object("record_data", "$._corrupt_record"), F.get_json_object("record_data", "$.payment_id"))
    return valid.select("payment_id", "amount", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("text")).unionByName(
        rejects.select(F.lit(None).cast("long").alias("payment_id"), F.lit(None).cast("decimal(12,2)").alias("amount"), "reason", text.alias("text")))


def broken_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2, S-8, I-6: each broken line is a reject of its own, recorded with its text."""
    path = scratch_dir(spark, "lines")
    _payment_lines(spark, sf_dir, path)
    spec = SPECS["payments"]
    tagged = ingest.prepare(load_json(spark, path, lines=True, schema=spec.feed_struct()), "payments")
    rejects = audit.rejected_records(tagged.where(~R.is_valid()), "lines", "payments", spec.column_names, RUN_TS)
    return _loaded_and_rejected(tagged.where(R.is_valid()), rejects)


def streamed_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines through the incremental file stream."""
    from tillroll.streaming import ingest_stream

    base = scratch_dir(spark, "line-stream")
    _payment_lines(spark, sf_dir, f"{base}/feed")
    store = TableStore(spark, f"{base}/wh")
    ingest_stream(spark, store, "payments", f"{base}/feed", f"{base}/ckpt", fmt="json", run_ts=RUN_TS)
    return _loaded_and_rejected(store.read("raw", "payments"), store.read_appended("audit", "rejected_records"))


def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-5, S-10: two stores over one root upsert in turn; no batch is lost, and small
    buckets make each upsert rewrite a part of the table."""
    root, spec = scratch_dir(spark, "writers"), SPECS["customers"]
    one, two = (TableStore(spark, root, bucket_bytes=1 << 15) for _ in range(2))
    k = F.col("c_custkey")

    def upsert(store: TableStore, day: int, where, suffix: str = "") -> None:
        feed = fixtures.customers_feed(spark, sf_dir, where=where, last_name_suffix=suffix)
        batch = ingest.prepare(feed, "customers").where(R.is_valid()).select(*spec.column_names)
        store.upsert(batch, "customers", spec.pk, spec.struct(), dt.datetime(2024, 1, day))

    upsert(one, 1, k % 3 == 0)
    upsert(two, 2, k % 3 == 1)
    upsert(one, 3, k % 3 == 2)
    upsert(two, 4, k % 6 == 0, "-v2")
    return one.read("raw", "customers").select("customer_id", "last_name", "email", F.dayofmonth("created_at").alias("created"), F.dayofmonth("updated_at").alias("updated"))


def products_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4: no extract has landed, so the snapshot alone is the products feed."""
    feed, label = products_input(lambda: fixtures.products_feed(spark, sf_dir), lambda: load_json(spark, scratch_dir(spark, "no-extract")))
    tagged = ingest.prepare(feed, "products")
    return tagged.where(R.is_valid()).select("product_id", "product_name", "category", "price", F.lit(label).alias("source"))


def appended_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-6, S-7: replace, append, truncate, append again."""
    store = TableStore(spark, scratch_dir(spark, "load"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    store.load(part, "parts", "replace")
    store.truncate("parts")
    store.load(part.where("p_partkey % 2 = 0"), "parts", "append")
    store.load(part.where("p_partkey % 2 = 1"), "parts", "append")
    return store.read("raw", "parts")


def quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-9: the rows that the quality checks leave in the audit layer."""
    results = checks.quality_checks(open_warehouse(spark, sf_dir).raw)
    return audit.quality_results(results, 7, RUN_TS).withColumn("checked_at", F.col("checked_at").cast("string"))


def reject_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-8, F-14: the rejected orders as recorded, unparsed text in place."""
    rejected = open_warehouse(spark, sf_dir).rejected().where("table_name = 'orders'")
    field = lambda name: F.get_json_object("record_data", f"$.{name}").alias(name)
    return rejected.select(field("order_id"), field("order_date"), "reason")


def title_case_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-2: part names in title and upper case."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_name").alias("upper"))
    return standardize_text_case(standardize_text_case(part, ["title"]), ["upper"], "upper")


def numbers_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-5, P-6: prices and dates from text, some of it unparsable."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    text = li.select(
        F.when(k % 7 == 0, F.lit("n.a.")).otherwise(F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("long").cast("string")).alias("cents"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.when(k % 5 == 0, " or later").otherwise("")).alias("day"),
    )
    return coerce_numeric(text, ["cents"], "decimal(18,0)").select("cents", parse_date("day").alias("day")).agg(
        F.count("cents").alias("n_numbers"), F.sum("cents").cast("long").alias("cents"), F.count("day").alias("n_days"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def default_discount_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-8, P-7: a feed without discounts, with some lines beyond the models' range."""
    k = F.col("order_id")
    feed = fixtures.order_items_feed(spark, sf_dir).drop("discount").withColumns({
        "quantity": F.when(k % 41 == 3, F.lit(2_000_000_000)).otherwise(F.col("quantity")),
        "unit_price": F.when(k % 41 == 3, F.lit("9999999999.99").cast("decimal(12,2)")).otherwise(F.col("unit_price")),
    })
    return _outcome(ingest.prepare(feed, "order_items"), "order_items")


def orders_without_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-1: a required column is missing, so every row is rejected."""
    return _outcome(ingest.prepare(fixtures.orders_feed(spark, sf_dir).drop("order_date"), "orders"), "orders")


def stores_without_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-9: stores with a missing name are rejected."""
    feed = fixtures.stores_feed(spark, sf_dir)
    feed = feed.withColumn("store_name", F.when(F.col("store_id") % 10 != 3, F.col("store_name")))
    return _outcome(ingest.prepare(feed, "stores"), "stores")


def invalid_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-6 on the raw text of the orders feed."""
    valid, invalid, reason = R.check_valid_date(fixtures.orders_feed(spark, sf_dir), "order_date")
    tagged = valid.select(F.lit(None).cast("string").alias("reason")).unionAll(invalid.select(F.lit(reason).alias("reason")))
    return tagged.groupBy("reason").agg(F.count("*").alias("n_rows"))


def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-7: per order the first line is valid, later ones repeat its id."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    _, invalid, reason = R.check_no_duplicate_ids(li.distinct(), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"])
    return invalid.groupBy("l_orderkey", F.lit(reason).alias("reason")).agg(F.count("*").alias("n_rows"))


def padded_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-9 with names padded to nine characters, for the days that have orders."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    names = calendar_attributes(F.col("d"), pad_names=True)
    return days.select(names["full_date"].alias("full_date"), names["month_name"].alias("month_name"), names["day_name"].alias("day_name"))


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-4, F-10: the calendar of the years that have valid orders."""
    return marts.dim_date_of(open_warehouse(spark, sf_dir).raw("orders"), "order_date")


def pipeline_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-5, F-13: how the build's run ended, from its events."""
    wh = open_warehouse(spark, sf_dir)
    runs = ledger.pipeline_runs(wh.store.read_appended("audit", ledger.LEDGER))
    last = runs.orderBy(F.desc("run_id")).limit(1)
    return last.select("pipeline_name", "status", "records_processed", F.col("started_at").cast("string").alias("started_at"),
                       F.col("watermark_end").cast("string").alias("watermark_end"))


QUERIES = {f.__name__: f for f in (
    csv_customers, quoted_products, json_payments, broken_json_lines, streamed_json_lines, two_writers, products_fallback, appended_parts, quality_results, reject_payloads, title_case_parts, numbers_from_text,
    default_discount_items, orders_without_date, stores_without_name, invalid_order_dates, duplicate_lines, padded_calendar, order_calendar,
    pipeline_outcome,
)}
