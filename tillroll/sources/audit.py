"""Audit sinks: rejected rows (S-8) and quality results (S-9)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import utc
from tillroll.operators.rules import CORRUPT_COLUMN, REASON, REASONS

QUALITY_STATUSES = ("pass", "fail", "warning")


def rejected_records(
    rejected: DataFrame,
    source: str,
    table_name: str,
    record_columns: Sequence[str],
    run_ts: dt.datetime,
) -> DataFrame:
    """One audit row per rejected row: the row as JSON (nulls kept), the first
    failed rule as ``reason`` and all failed rules as ``reasons``. A row with text
    that didn't parse is recorded as text throughout, with that text in place; of a
    record that is malformed as a whole the text itself is recorded, as
    ``{"_corrupt_record": ...}``."""
    keep = {"ignoreNullFields": "false"}
    record = F.to_json(F.struct(*record_columns), keep)
    raw = rejected.schema["_raw"].dataType.names if "_raw" in rejected.columns else []
    malformed = CORRUPT_COLUMN in raw
    raw = [c for c in raw if c in record_columns]
    if raw:
        unparsed = F.coalesce(*[F.col(f"_raw.{c}") for c in raw]).isNotNull()
        text = F.struct(*[
            (F.coalesce(F.col(c).cast("string"), F.col(f"_raw.{c}")) if c in raw else F.col(c).cast("string")).alias(c)
            for c in record_columns
        ])
        record = F.when(unparsed, F.to_json(text, keep)).otherwise(record)
    if malformed:
        line = F.col(f"_raw.{CORRUPT_COLUMN}")
        record = F.when(line.isNotNull(), F.to_json(F.struct(line.alias(CORRUPT_COLUMN)))).otherwise(record)
    return rejected.select(
        F.lit(source).alias("source"),
        F.lit(table_name).alias("table_name"),
        record.alias("record_data"),
        F.col(REASON).alias("reason"),
        F.col(REASONS).alias("reasons"),
        utc(run_ts).alias("rejected_at"),
    )


def quality_results(checks: DataFrame, run_id: int, run_ts: dt.datetime) -> DataFrame:
    """Rows for audit.data_quality_results; status is one of pass/fail/warning."""
    bad = F.col("status").isin(*QUALITY_STATUSES)
    return checks.select(
        F.lit(run_id).cast("long").alias("pipeline_run_id"),
        "table_name",
        "check_name",
        F.when(bad, F.col("status")).otherwise(
            F.raise_error(F.concat(F.lit("status must be 'pass', 'fail' or 'warning': "), F.col("status")))
        ).alias("status"),
        "failed_rows",
        utc(run_ts).alias("checked_at"),
    )
