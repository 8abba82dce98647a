"""Expose a built warehouse under the reference's schema names.

``register_catalog`` creates the ``raw``, ``staging``, ``warehouse`` and
``audit`` databases in the session catalog: one external Parquet table per current
table version, and views for the staging and intermediate models and for the state
of runs, so SQL written against those names runs with ``spark.sql``. The tables
point at committed, immutable version folders; re-registering after a
new build repoints them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillroll.plans import ingest, staging
from tillroll.sources import fs

MARTS = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales")


def _drop(spark: SparkSession, qualified: str) -> None:
    if not spark.catalog.tableExists(qualified):
        return
    kind = spark.catalog.getTable(qualified).tableType
    spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {qualified}")


def _table(spark: SparkSession, db: str, name: str, path: str, where: str | None = None) -> None:
    _drop(spark, f"{db}.{name}")
    _drop(spark, f"{db}.{name}__batch")
    if where is None:
        spark.sql(f"CREATE TABLE {db}.{name} USING parquet LOCATION '{path}'")
        return
    # tagged bronze version: expose its valid rows without the tag columns
    spark.sql(f"CREATE TABLE {db}.{name}__batch USING parquet LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {db}.{name}__batch RECOVER PARTITIONS")
    _view(spark, f"{db}.{name}", f"SELECT {_columns(spark, f'{db}.{name}__batch')} FROM {db}.{name}__batch WHERE {where}")


def _columns(spark: SparkSession, table: str) -> str:
    return ", ".join(c for c in spark.table(table).columns if not c.startswith("_"))


def _view(spark: SparkSession, name: str, sql: str) -> None:
    _drop(spark, name)
    spark.sql(f"CREATE VIEW {name} AS {sql}")


def _raw_table(spark: SparkSession, store, name: str) -> None:
    """A bronze table as it reads: one folder, or the folders of its appends."""
    folders = store.folders("raw", name)
    for i, path in enumerate(folders):
        part = name if len(folders) == 1 else f"{name}__part{i}"
        _table(spark, "raw", part, path, "_status = 'valid'" if store.is_tagged(path) else None)
    if len(folders) > 1:
        columns = _columns(spark, f"raw.{name}__part0")
        _view(spark, f"raw.{name}", " UNION ALL ".join(f"SELECT {columns} FROM raw.{name}__part{i}" for i in range(len(folders))))


ORDER_METRICS = """
SELECT order_id, count(*) AS item_count, cast(sum(quantity) AS bigint) AS total_quantity,
       cast(sum(cast(quantity * unit_price - discount AS decimal(18,2))) AS decimal(38,2)) AS order_subtotal
FROM staging.stg_order_items GROUP BY order_id"""

CUSTOMER_ORDERS = """
SELECT customer_id, count(DISTINCT order_id) AS total_orders, cast(sum(order_subtotal) AS decimal(38,2)) AS lifetime_spend,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM staging.stg_orders JOIN staging.int_order_metrics USING (order_id) GROUP BY customer_id"""

# the state of a run from its events; the last finish wins
PIPELINE_RUNS = """
SELECT run_id, max(pipeline_name) AS pipeline_name, min(event_at) FILTER (WHERE event = 'start') AS started_at,
       max(event_at) FILTER (WHERE event = 'finish') AS completed_at, max_by(status, seen) AS status,
       max_by(records_processed, seen) AS records_processed, max(watermark_start) AS watermark_start,
       max_by(watermark_end, seen) AS watermark_end, max_by(error_message, seen) AS error_message
FROM (SELECT *, struct(event = 'finish', event_at) AS seen FROM audit.pipeline_events) GROUP BY run_id"""


def register_catalog(spark: SparkSession, wh) -> list[str]:
    """Create/refresh ``raw.*``, ``staging.*``, ``warehouse.*`` and ``audit.*``;
    returns the names."""
    names = []
    for db in ("raw", "staging", "warehouse", "audit"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for t in ingest.TABLE_ORDER:
        _raw_table(spark, wh.store, t)
        _view(spark, f"staging.stg_{t}", staging.view_sql(t, f"raw.{t}"))
        names += [f"raw.{t}", f"staging.stg_{t}"]
    _view(spark, "staging.int_order_metrics", ORDER_METRICS)
    _view(spark, "staging.int_customer_orders", CUSTOMER_ORDERS)
    names += ["staging.int_order_metrics", "staging.int_customer_orders"]
    for m in MARTS:
        _table(spark, "warehouse", m, wh.store.current_path("marts", m))
        names.append(f"warehouse.{m}")
    for a in ("rejected_records", "data_quality_results", "model_test_results", "pipeline_events"):
        path = wh.store.path("audit", a)
        if fs.exists(spark, path):
            _table(spark, "audit", a, path)
            spark.sql(f"ALTER TABLE audit.{a} RECOVER PARTITIONS")
            names.append(f"audit.{a}")
    if "audit.pipeline_events" in names:
        _view(spark, "audit.pipeline_runs", PIPELINE_RUNS)
        names.append("audit.pipeline_runs")
    return names
