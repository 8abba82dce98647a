"""Registered queries beyond the reports: ingestion, audit, checks, tests,
models, overlay, upsert, ledger and incremental load. Each takes
``(spark, sf_dir)`` and reads the given tables or the warehouse built from
them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.rules import is_valid
from tillroll.plans import checks, feature_queries, ingest, ledger, marts, model_tests
from tillroll.plans.pipeline import models_of
from tillroll.plans.warehouse import STATUS, Warehouse, last_batch, open_warehouse
from tillroll.schemas import SPECS
from tillroll.session import scratch_dir
from tillroll.sources import fixtures
from tillroll.sources.overlay import overlay_products
from tillroll.sources.tables import TableStore

WATERMARK = dt.datetime(1999, 1, 1)
NARROW_CALENDAR = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return open_warehouse(spark, sf_dir)


def ingest_summary(spark, sf_dir) -> DataFrame:
    """I-7: rows loaded / rejected per table, from each table's last tagged batch."""
    wh = _wh(spark, sf_dir)
    parts = [
        last_batch(wh, n).agg(
            F.count_if(F.col(STATUS) == "valid").alias("rows_loaded"),
            F.count_if(F.col(STATUS) == "rejected").alias("rows_rejected"),
        ).select(F.lit(n).alias("table_name"), "rows_loaded", "rows_rejected")
        for n in ingest.TABLE_ORDER
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rejected_by_reason(spark, sf_dir) -> DataFrame:
    """S-8 / V-10: rejected rows per table and first failed rule."""
    rej = _wh(spark, sf_dir).rejected()
    return rej.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def validation_dry_run(spark, sf_dir) -> DataFrame:
    """I-8 over the five feeds (no cleaning, no writes)."""
    feeds = {n: fixtures.feed(spark, sf_dir, n) for n in ingest.DRY_RUN_FEEDS}
    return ingest.validation_dry_run(feeds)


def quality_checks(spark, sf_dir) -> DataFrame:
    return checks.quality_checks(_wh(spark, sf_dir).raw)


def model_test_results(spark, sf_dir) -> DataFrame:
    return model_tests.run_model_tests(models_of(_wh(spark, sf_dir)))


def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


def dim_customer(spark, sf_dir) -> DataFrame:
    return _no_ts(_wh(spark, sf_dir).dim("customer"))


def dim_product(spark, sf_dir) -> DataFrame:
    return _no_ts(_wh(spark, sf_dir).dim("product"))


def dim_store(spark, sf_dir) -> DataFrame:
    return _no_ts(_wh(spark, sf_dir).dim("store"))


def dim_date(spark, sf_dir) -> DataFrame:
    return _wh(spark, sf_dir).dim("date")


def fact_sales(spark, sf_dir) -> DataFrame:
    return _no_ts(_wh(spark, sf_dir).fact)


def int_order_metrics(spark, sf_dir) -> DataFrame:
    return marts.int_order_metrics(_wh(spark, sf_dir).stg()["order_items"])


def int_customer_orders(spark, sf_dir) -> DataFrame:
    stg = _wh(spark, sf_dir).stg()
    return marts.int_customer_orders(stg["orders"], marts.int_order_metrics(stg["order_items"]))


def latest_payment(spark, sf_dir) -> DataFrame:
    return marts.latest_payment(_wh(spark, sf_dir).stg()["payments"])


def narrow_calendar_fact_rows(spark, sf_dir) -> DataFrame:
    """Fact lines kept by a 1996-2000 calendar: out-of-calendar orders drop (J-5)."""
    wh = _wh(spark, sf_dir)
    dims = {k: wh.dim(k) for k in ("customer", "product", "store")}
    dims["date"] = marts.dim_date(spark, *NARROW_CALENDAR)
    lines = marts.fact_lines(wh.stg(), dims, wh.run_ts)
    return lines.agg(F.count(F.lit(1)).alias("fact_rows"))


def products_overlay(spark, sf_dir) -> DataFrame:
    """S-3: snapshot overlaid by the landed API extract, then the products job."""
    feed = overlay_products(fixtures.products_feed(spark, sf_dir), fixtures.products_api_extract(spark, sf_dir))
    tagged = ingest.prepare(feed, "products")
    return tagged.filter(is_valid()).select(*SPECS["products"].column_names)


def customers_upsert(spark, sf_dir) -> DataFrame:
    """S-5: load a first customer batch (with city), then upsert a second one
    (changed last names, no city column, new ids); returns the final table."""
    store = TableStore(spark, scratch_dir(spark, "upsert"))
    spec = SPECS["customers"]
    run1, run2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    first = ingest.prepare(fixtures.customers_feed(spark, sf_dir, with_city=True), "customers")
    store.upsert(first.filter(is_valid()), "customers", spec.pk, spec.struct(), run1)
    k = F.col("c_custkey")
    changed = fixtures.customers_feed(spark, sf_dir, where=k % 5 == 0, last_name_suffix="-v2")
    new = fixtures.customers_feed(spark, sf_dir, where=k % 25 == 1, id_offset=10_000_000)
    batch = ingest.prepare(changed.unionByName(new), "customers").filter(is_valid()).drop("city")
    batch = batch.select(*[c for c in batch.columns if c in ("customer_id", "first_name", "last_name", "email", "signup_date")])
    final = store.upsert(batch, "customers", spec.pk, spec.struct(), run2)
    return final.drop("created_at", "updated_at")


def last_successful_watermark(spark, sf_dir) -> DataFrame:
    """G-3 per pipeline over a ledger derived from the events table."""
    runs = ledger.pipeline_runs(ledger.fixture_ledger_events(spark, sf_dir))
    return ledger.last_successful_watermarks(runs)


def pipeline_run_summary(spark, sf_dir) -> DataFrame:
    """G-1/G-2: run states rebuilt from start/finish events."""
    runs = ledger.pipeline_runs(ledger.fixture_ledger_events(spark, sf_dir))
    return runs.groupBy("pipeline_name", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("records_processed").cast("long").alias("records_processed"),
        F.count("watermark_end").alias("runs_with_watermark"),
    )


def incremental_orders(spark, sf_dir) -> DataFrame:
    """G-4: orders changed after the watermark, through the orders job."""
    feed = ledger.incremental(fixtures.orders_feed(spark, sf_dir), WATERMARK)
    tagged = ingest.prepare(feed, "orders")
    return tagged.filter(is_valid()).select(*SPECS["orders"].column_names)


def streamed_orders(spark, sf_dir) -> DataFrame:
    """S-1 + G-4 end to end: the orders feed is landed as CSV files, then
    loaded by the incremental file stream into a fresh bronze table."""
    from tillroll.streaming import ingest_stream

    base = scratch_dir(spark, "stream")
    spec = SPECS["orders"]
    feed = fixtures.orders_feed(spark, sf_dir).select(*[F.col(c).cast("string") for c in spec.column_names])
    feed.write.option("header", True).csv(f"{base}/feed")
    store = TableStore(spark, f"{base}/wh")
    ingest_stream(spark, store, "orders", f"{base}/feed", f"{base}/ckpt", run_ts=dt.datetime(2024, 1, 1))
    return store.read("raw", "orders").select(*spec.column_names)


QUERIES = {
    "ingest_summary": ingest_summary,
    "rejected_by_reason": rejected_by_reason,
    "validation_dry_run": validation_dry_run,
    "quality_checks": quality_checks,
    "model_tests": model_test_results,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_store": dim_store,
    "dim_date": dim_date,
    "fact_sales": fact_sales,
    "int_order_metrics": int_order_metrics,
    "int_customer_orders": int_customer_orders,
    "latest_payment": latest_payment,
    "narrow_calendar_fact_rows": narrow_calendar_fact_rows,
    "products_overlay": products_overlay,
    "customers_upsert": customers_upsert,
    "last_successful_watermark": last_successful_watermark,
    "pipeline_run_summary": pipeline_run_summary,
    "incremental_orders": incremental_orders,
    "streamed_orders": streamed_orders,
}

QUERIES.update(feature_queries.QUERIES)
