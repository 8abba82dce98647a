"""Ingestion jobs (I-1 ... I-8): clean -> coerce -> keep-first -> validate.

``prepare`` turns a feed into ONE tagged DataFrame (typed columns plus
``_reasons``/``_reason``); valid rows go to the bronze upsert, the rest to the
reject sink. De-duplication runs before validation, as in the reference, so a
bad first copy hides a good later one; dropped copies are not rejects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.coerce import coerce_to
from tillroll.functions.text import normalize_emails, trim_whitespace
from tillroll.operators import rules as R
from tillroll.operators.dedup import drop_exact_duplicates
from tillroll.schemas import SPECS, VALID_PAYMENT_STATUSES, TableSpec
from tillroll.sources.fixtures import SEQ

# struct of the texts that didn't parse, by column
RAW = "_raw"


@dataclass(frozen=True)
class IngestJob:
    spec: TableSpec
    rules: tuple = field(default_factory=tuple)
    required_reason: str | None = None
    default_discount: bool = False


def _jobs() -> dict[str, IngestJob]:
    return {
        "customers": IngestJob(SPECS["customers"]),
        # Fixed value that must equal the reference's stores reject reason.
        "stores": IngestJob(SPECS["stores"], required_reason="missing store_id or store_name"),
        "products": IngestJob(SPECS["products"], (R.non_negative("price"),)),
        "orders": IngestJob(SPECS["orders"]),
        "order_items": IngestJob(
            SPECS["order_items"],
            (
                R.positive("quantity"),
                R.non_negative("unit_price"),
                R.non_negative("discount"),
                R.discount_not_exceed_line_value(),
                R.line_value_in_range(),
            ),
            default_discount=True,
        ),
        "payments": IngestJob(
            SPECS["payments"],
            (R.non_negative("amount"), R.accepted_values("payment_status", VALID_PAYMENT_STATUSES)),
        ),
    }


TABLE_ORDER = ("customers", "stores", "products", "orders", "order_items", "payments")


def job(name: str) -> IngestJob:
    return _jobs()[name]


def prepare(feed: DataFrame, name: str) -> DataFrame:
    """Tagged, typed, de-duplicated batch for table ``name``."""
    jb = job(name)
    spec = jb.spec
    missing = R.missing_columns(feed, spec.required_columns)
    df = feed
    if SEQ not in df.columns:
        raise ValueError(f"feed for {name} has no {SEQ} order column")
    # clean (absent columns are ignored, as in the reference)
    df = trim_whitespace(df, spec.trim)
    for c in spec.lower:
        df = normalize_emails(df, c)
    # P-8: the discount column defaults to 0 when the feed has none
    if jb.default_discount and "discount" not in df.columns:
        df = df.withColumn("discount", F.lit(0))
    # coerce every declared column; absent ones become typed nulls. Text that
    # doesn't parse is kept beside its null: it keeps rows with different bad ids
    # apart and goes into the reject record.
    typed, raw = [], []
    for c in spec.columns:
        if c.name not in df.columns:
            typed.append(F.lit(None).cast(c.dtype).alias(c.name))
            continue
        value = coerce_to(c.name, c.dtype, df.schema[c.name].dataType)
        typed.append(value.alias(c.name))
        if isinstance(df.schema[c.name].dataType, T.StringType) and c.dtype != "string":
            raw.append(F.when(value.isNull(), F.col(c.name)).alias(c.name))
    # so is the text of a record that is malformed as a whole
    if R.CORRUPT_COLUMN in df.columns:
        raw.append(F.col(R.CORRUPT_COLUMN))
    df = df.select(
        *typed,
        (F.struct(*raw) if raw else F.lit(None).cast("struct<none:string>")).alias(RAW),
        *([F.col(R.CORRUPT_COLUMN)] if R.CORRUPT_COLUMN in df.columns else []),
        F.col(SEQ),
    )
    if not missing:
        # with required columns absent every row is rejected as it is (V-1);
        # a missing key column must not collapse the batch into one row
        unparsed = [f.name for f in df.schema[RAW].dataType.fields]
        keys = [*spec.pk, *(f"_key_{c}" for c in spec.pk if c in unparsed)]
        df = df.withColumns({f"_key_{c}": F.col(f"{RAW}.{c}") for c in spec.pk if c in unparsed})
        if R.CORRUPT_COLUMN in df.columns:
            # a malformed record is no copy of another: its place in the feed is its key
            df = df.withColumn("_key_place", F.when(F.col(R.CORRUPT_COLUMN).isNotNull(), F.col(SEQ)))
            keys.append("_key_place")
        df = drop_exact_duplicates(df, keys, order=[SEQ])
    rules: list[R.Rule] = []
    if R.CORRUPT_COLUMN in df.columns:
        rules.append(R.Rule("malformed record", F.col(R.CORRUPT_COLUMN).isNull()))
    rules += R.required_rules(spec, jb.required_reason) + list(jb.rules)
    batch_reason = f"Missing required columns: {missing}" if missing else None
    tagged = R.tag(df, rules, batch_reason)
    return tagged.select(*spec.column_names, R.REASONS, R.REASON, RAW)


def summary(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """I-7: (table_name, rows_loaded, rows_rejected) — one aggregate per table."""
    parts = [
        t.agg(
            F.count_if(R.is_valid()).cast("long").alias("rows_loaded"),
            F.count_if(~R.is_valid()).cast("long").alias("rows_rejected"),
        ).select(F.lit(name).alias("table_name"), "rows_loaded", "rows_rejected")
        for name, t in tagged.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# I-8 covers five feeds; stores are not part of the dry run.
DRY_RUN_FEEDS = ("customers", "products", "orders", "order_items", "payments")


def validation_dry_run(feeds: Mapping[str, DataFrame | None], names: Sequence[str] = DRY_RUN_FEEDS) -> DataFrame:
    """I-8: load + missing-column/required-null checks only (no cleaning, no
    writes). status: OK / ISSUES FOUND / SKIPPED (feed absent)."""
    parts = []
    spark = None
    for name in names:
        df = feeds.get(name)
        spec = SPECS[name]
        if df is None:
            continue
        spark = df.sparkSession
        missing = R.missing_columns(df, spec.required_columns)
        if missing:
            bad = F.lit(True)
        else:
            bad = F.lit(False)
            for c in spec.required_columns:
                bad = bad | F.col(c).isNull()
        parts.append(
            df.agg(
                F.count_if(~bad).cast("long").alias("valid_rows"),
                F.count_if(bad).cast("long").alias("invalid_rows"),
            ).select(
                F.lit(name).alias("feed"),
                F.when(F.col("invalid_rows") == 0, F.lit("OK")).otherwise(F.lit("ISSUES FOUND")).alias("status"),
                "valid_rows",
                "invalid_rows",
            )
        )
    skipped = [n for n in names if feeds.get(n) is None]
    if skipped and spark is not None:
        parts.append(
            spark.createDataFrame(
                [(n, "SKIPPED", None, None) for n in skipped],
                "feed string, status string, valid_rows long, invalid_rows long",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
