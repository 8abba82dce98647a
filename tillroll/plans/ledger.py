"""Run ledger and high-water marks (G-1 ... G-4).

The ledger is append-only: starting a run appends a ``start`` event,
finishing it appends a ``finish`` event; nothing is updated in place. The
state of a run is an aggregate over its events (latest event wins), and the
last successful watermark is ``max_by(watermark_end, completed_at)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.calendar import aware, utc
from tillroll.sources import fs
from tillroll.sources.tables import TableStore

LEDGER = "pipeline_events"
EVENT_SCHEMA = (
    "run_id long, pipeline_name string, event string, event_at timestamp, status string, "
    "records_processed long, watermark_start timestamp, watermark_end timestamp, error_message string"
)
RUN_IDS = "run_ids"


def _events(store: TableStore) -> DataFrame:
    return store.read_appended("audit", LEDGER, store.spark.createDataFrame([], EVENT_SCHEMA).schema)


def _append(store: TableStore, row: tuple) -> None:
    row = tuple(aware(v) if isinstance(v, dt.datetime) else v for v in row)
    # a folder of its own: runs that write together don't share a commit
    store.append(store.spark.createDataFrame([row], EVENT_SCHEMA), "audit", LEDGER, part=f"{row[0]:012d}-{row[2]}")


def _has_ledger(store: TableStore) -> bool:
    return fs.exists(store.spark, store.path("audit", LEDGER))


def next_run_id(store: TableStore) -> int:
    """Claim the next run id. A claim is a file that only one caller can create, so
    runs that start together get different ids."""
    last = _events(store).agg(F.max("run_id")).collect()[0][0] if _has_ledger(store) else None
    run_id = int(last or 0) + 1
    while not fs.create_new(store.spark, f"{store.path('audit', RUN_IDS)}/{run_id:012d}"):
        run_id += 1
    return run_id


def record_start(
    store: TableStore, run_id: int, pipeline_name: str, watermark_start: dt.datetime | None,
    at: dt.datetime | None = None,
) -> None:
    """Append the ``running`` start event of ``run_id``."""
    at = at or dt.datetime.now(dt.timezone.utc)
    _append(store, (run_id, pipeline_name, "start", at, "running", None, watermark_start, None, None))


def start_pipeline_run(
    store: TableStore, pipeline_name: str, watermark_start: dt.datetime | None, at: dt.datetime | None = None
) -> int:
    """G-1: append a ``running`` start event; returns the new run id."""
    run_id = next_run_id(store)
    record_start(store, run_id, pipeline_name, watermark_start, at)
    return run_id


def finish_pipeline_run(
    store: TableStore,
    run_id: int,
    status: str,
    records_processed: int = 0,
    watermark_end: dt.datetime | None = None,
    error_message: str | None = None,
    at: dt.datetime | None = None,
) -> None:
    """G-2: append a finish event; status must be success or failed."""
    if status not in ("success", "failed"):
        raise ValueError("status must be 'success' or 'failed'")
    at = at or dt.datetime.now(dt.timezone.utc)
    name = _events(store).filter(F.col("run_id") == run_id).select("pipeline_name").limit(1).collect()
    _append(store, (run_id, name[0][0] if name else None, "finish", at, status, records_processed,
                    None, watermark_end, error_message))


def pipeline_runs(events: DataFrame) -> DataFrame:
    """Current state per run: start fields plus the latest finish fields."""
    is_start = F.col("event") == "start"
    is_finish = F.col("event") == "finish"
    latest = F.max_by(
        F.struct("status", "records_processed", "watermark_end", "error_message",
                 F.when(is_finish, F.col("event_at")).alias("completed_at")),
        F.struct(is_finish.cast("int"), F.col("event_at")),
    )
    runs = events.groupBy("run_id").agg(
        F.max("pipeline_name").alias("pipeline_name"),
        F.min(F.when(is_start, F.col("event_at"))).alias("started_at"),
        F.max(F.when(is_start, F.col("watermark_start"))).alias("watermark_start"),
        latest.alias("_l"),
    )
    return runs.select(
        "run_id", "pipeline_name", "started_at", F.col("_l.completed_at").alias("completed_at"),
        F.col("_l.status").alias("status"), F.col("_l.records_processed").alias("records_processed"),
        "watermark_start", F.col("_l.watermark_end").alias("watermark_end"),
        F.col("_l.error_message").alias("error_message"),
    )


def last_successful_watermarks(runs: DataFrame) -> DataFrame:
    """Per pipeline: watermark_end of the latest successful run (null if that
    run recorded none). Pipelines without a success are absent (full load)."""
    ok = runs.filter(F.col("status") == "success")
    return ok.groupBy("pipeline_name").agg(
        F.max_by("watermark_end", F.struct("completed_at", "run_id")).alias("watermark_end")
    )


def get_last_successful_watermark(store: TableStore, pipeline_name: str) -> dt.datetime | None:
    """G-3, in UTC: None on the first run of a pipeline, meaning "load everything"."""
    if not _has_ledger(store):
        return None
    runs = pipeline_runs(_events(store)).filter(F.col("pipeline_name") == pipeline_name)
    row = last_successful_watermarks(runs).select(F.unix_micros("watermark_end").alias("t")).collect()
    if not row or row[0]["t"] is None:
        return None
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=row[0]["t"])


def incremental(df: DataFrame, watermark: dt.datetime | dt.date | None, column: str = "updated_at") -> DataFrame:
    """G-4: rows changed after the watermark (everything when there is none).
    A plain filter, so it reaches the scan as a pushed predicate. A watermark
    without a zone is UTC."""
    if watermark is None:
        return df
    return df.filter(F.col(column) > (utc(watermark) if isinstance(watermark, dt.datetime) else F.lit(watermark)))


def fixture_ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events derived from the ``events`` table: one run per event
    (start one minute before ``ts``, finish at ``ts``)."""
    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    k = F.col("event_id")
    name = F.when(k % 3 == 0, F.lit("full-pipeline")).when(k % 3 == 1, F.lit("adhoc-quality-check")).otherwise(
        F.lit("incremental-orders")
    )
    ok = F.col("event_type").isin("purchase", "view", "signup")
    status = F.when(ok, F.lit("success")).otherwise(F.lit("failed"))
    ts = F.col("ts").cast("timestamp")
    # quality runs record success without a watermark; failed runs record none
    wm_end = F.when(ok & (k % 3 != 1), ts)
    start = F.struct(
        k.alias("run_id"), name.alias("pipeline_name"), F.lit("start").alias("event"),
        (ts - F.expr("INTERVAL 1 MINUTE")).alias("event_at"), F.lit("running").alias("status"),
        F.lit(None).cast("long").alias("records_processed"), F.lit(None).cast("timestamp").alias("watermark_start"),
        F.lit(None).cast("timestamp").alias("watermark_end"), F.lit(None).cast("string").alias("error_message"),
    )
    finish = F.struct(
        k.alias("run_id"), name.alias("pipeline_name"), F.lit("finish").alias("event"), ts.alias("event_at"),
        status.alias("status"), (k % 1000).alias("records_processed"),
        F.lit(None).cast("timestamp").alias("watermark_start"), wm_end.alias("watermark_end"),
        F.when(~ok, F.concat(F.lit("run failed: "), F.col("event_type"))).alias("error_message"),
    )
    return e.select(F.explode(F.array(start, finish)).alias("ev")).select("ev.*")
