"""Build and open the warehouse for one input folder.

``build`` runs the batch pipeline over the fixture feeds derived from the
given tables: tag each feed once and write it once (the first bronze version,
partitioned by status; later batches land and merge), append the rejects to
the audit table, gate on the quality checks, then materialise the dimensions
and the fact and run the model tests.
Every stage boundary is a committed Parquet write under the cluster's shared
folder (``spark.checkpoint.dir``), so a lost executor costs a task retry, not
the run. ``open_warehouse`` reuses a completed build of the same input.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import threading
import uuid
from pathlib import Path
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.calendar import utc
from tillroll.operators.rules import REASON, REASONS, is_valid
from tillroll.plans import ingest, marts, staging
from tillroll.schemas import SPECS
from tillroll.session import tune, work_root
from tillroll.sources import audit, clustered, fixtures, fs
from tillroll.sources.tables import STATUS, TAG_COLUMNS, TableStore

def _source_fingerprint() -> str:
    """Hash of the library's source: a build made by other code is never reused."""
    root = Path(__file__).resolve().parents[1]
    h = hashlib.sha256()
    for f in sorted(root.rglob("*.py")):
        h.update(str(f.relative_to(root)).encode())
        h.update(f.read_bytes())
    return h.hexdigest()[:16]


BUILD_VERSION = _source_fingerprint()
# A fixed run timestamp keeps rebuilt tables byte-identical across reruns.
DEFAULT_RUN_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
_LOCK = threading.Lock()
_OPEN: dict[tuple[int, str], tuple[str, "Warehouse"]] = {}
log = logging.getLogger(__name__)


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    sf_dir: str
    # first and last day of dim_date; None: the whole years that the orders span
    calendar: tuple[dt.date, dt.date] | None = None
    run_ts: dt.datetime = DEFAULT_RUN_TS
    store: TableStore = field(init=False)
    last_run: object = None
    # buckets of the copies on order_id; None: as many as a shuffle's partitions then
    buckets: int | None = None

    def __post_init__(self) -> None:
        self.store = TableStore(self.spark, self.root)
        known = f"{self.root}/clustered/_buckets"
        if self.buckets is None and fs.exists(self.spark, known):
            self.buckets = int(fs.read_text(self.spark, known))

    # layers
    def raw(self, name: str) -> DataFrame:
        """A bronze table; those of orders as bucketed on order_id once that is done."""
        if name in BY_ORDER and self.buckets is not None:
            copy = clustered.clustered(self.store, "raw", name, "order_id", self.buckets)
            if copy is not None:
                return copy
        return self.store.read("raw", name)

    def cluster_orders(self) -> None:
        """Copies of orders, order lines and payments on order_id, in like buckets."""
        sizes = [sum(fs.size(self.spark, f) for f in self.store.folders("raw", n)) for n in BY_ORDER]
        buckets = clustered.bucket_count(self.spark, max(sizes))
        with ThreadPoolExecutor(max_workers=len(BY_ORDER)) as pool:
            for f in [pool.submit(clustered.cluster, self.store, "raw", n, "order_id", buckets) for n in BY_ORDER if self.store.exists("raw", n)]:
                f.result()
        fs.write_text(self.spark, f"{self.root}/clustered/_buckets", str(buckets))
        self.buckets = buckets

    def mart(self, name: str) -> DataFrame:
        return self.store.read("marts", name)

    def stg(self) -> dict[str, DataFrame]:
        return staging.staging(self.raw)

    def rejected(self) -> DataFrame:
        return self.store.read_appended("audit", "rejected_records")

    @property
    def fact(self) -> DataFrame:
        return self.mart("fact_sales")

    def dim(self, name: str) -> DataFrame:
        return self.mart(f"dim_{name}")

    @property
    def status(self) -> str:
        """How the build's run ended: success, or failed (a model test failed; the
        tables are complete). The reports show what is there either way."""
        return self.last_run.status if self.last_run is not None else fs.read_text(self.spark, f"{self.root}/_COMPLETE")

    def feed(self, name: str) -> DataFrame:
        return fixtures.feed(self.spark, self.sf_dir, name)


# bronze tables that plans join or group on order_id
BY_ORDER = ("orders", "order_items", "payments")
# the given tables that the feeds are projected from
INPUTS = ("customer", "supplier", "nation", "region", "part", "orders", "lineitem", "events")


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """Files, bytes and times of the input tables: other content, another state."""
    base = sf_dir.rstrip("/")
    return "|".join(fs.fingerprint(spark, f"{base}/{t}.parquet") for t in INPUTS)


def _root_for(spark: SparkSession, sf_dir: str, calendar, state: str) -> str:
    key = f"{sf_dir.rstrip('/')}|{calendar}|{BUILD_VERSION}|{state}"
    return f"{work_root(spark)}/wh-{hashlib.sha256(key.encode()).hexdigest()[:16]}"


def ingest_table(wh: Warehouse, name: str, feed: DataFrame, source: str) -> tuple[int, int]:
    """One feed: tag once and write the tagged batch once; returns the rows loaded and
    rejected, counted while they are written.

    Initial load (no bronze table yet): the tagged batch, partitioned by
    status, IS the first bronze version, so valid rows are written exactly
    once. Later batches land first, then merge into a new bronze version.
    Rejects are read back from the ``rejected`` partition of that write.
    """
    spec = SPECS[name]
    ts = utc(wh.run_ts)
    tagged = ingest.prepare(feed, name)
    seen = Observation()
    landed = tagged.withColumn(STATUS, F.when(is_valid(), F.lit("valid")).otherwise(F.lit("rejected"))).observe(
        seen, F.count_if(is_valid()).alias("loaded"), F.count_if(~is_valid()).alias("rejected"))
    if not wh.store.exists("raw", name):
        first = landed.withColumns({"created_at": ts, "updated_at": ts})
        path = wh.store.write(first, "raw", name, partition_by=[STATUS])
        if not wh.store.is_tagged(path):
            # an empty feed leaves no partition and so no schema to read
            wh.store.write(wh.spark.createDataFrame([], first.drop(STATUS, *TAG_COLUMNS).schema), "raw", name)
            return 0, 0
        batch = wh.store.read_batch("raw", name)
    else:
        path = wh.store.write(landed, "landing", name, partition_by=[STATUS])
        if not wh.store.is_tagged(path):
            return 0, 0  # an empty feed changes nothing
        batch = wh.store.read_batch("landing", name)
        # only columns the feed really has overwrite stored values (a missing
        # discount column counts as present: it defaults to 0 before loading)
        present = [c for c in spec.column_names
                   if c in feed.columns or (c == "discount" and ingest.job(name).default_discount)]
        valid = batch.filter(F.col(STATUS) == "valid").select(*present)
        wh.store.upsert(valid, name, spec.pk, spec.struct(), wh.run_ts)
    rejected = batch.filter(F.col(STATUS) == "rejected")
    rej = audit.rejected_records(rejected, source, name, spec.column_names, wh.run_ts)
    wh.store.append(rej, "audit", "rejected_records", part=name)
    counts = seen.get
    return counts["loaded"], counts["rejected"]


def last_batch(wh: Warehouse, name: str) -> DataFrame:
    """The most recent tagged batch of a table: its first load or the last landed
    feed; no rows if that feed was empty."""
    for layer in ("landing", "raw"):
        path = wh.store.current_path(layer, name)
        if path is not None and wh.store.is_tagged(path):
            return wh.store.read_batch(layer, name)
        if path is not None and layer == "landing":
            break
    first = wh.raw(name).limit(0)
    return first.withColumns({STATUS: F.lit("valid"), REASON: F.lit(""), REASONS: F.array().cast("array<string>")})


def build_marts(wh: Warehouse, lap=None) -> None:
    stg = wh.stg()
    scratch = f"{wh.root}/scratch/{uuid.uuid4().hex[:12]}"
    jobs = {
        "dim_customer": lambda s: marts.dim_customer(stg["customers"], wh.run_ts, scratch=s),
        "dim_product": lambda s: marts.dim_product(stg["products"], wh.run_ts, scratch=s),
        "dim_store": lambda s: marts.dim_store(stg["stores"], wh.run_ts, scratch=s),
        "dim_date": lambda s: marts.dim_date(wh.spark, *wh.calendar) if wh.calendar else marts.dim_date_of(stg["orders"], "order_date"),
    }

    def stored(name: str, model) -> None:
        # the folder holds rows on their way to the table; it goes when they are there
        wh.store.write(model(f"{scratch}/{name}"), "marts", name)
        fs.delete(wh.spark, f"{scratch}/{name}")

    # independent dimensions: their jobs run concurrently
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(stored, n, f) for n, f in jobs.items()]
        for fut in futures:
            fut.result()
    if lap:
        lap("dimensions")
    dims = {k: wh.dim(k) for k in ("customer", "product", "store", "date")}
    lines = marts.fact_lines(stg, dims, wh.run_ts)
    stored("fact_sales", lambda s: marts.fact_sales(lines, scratch=s))
    if lap:
        lap("fact")


def build(
    spark: SparkSession,
    sf_dir: str,
    root: str | None = None,
    calendar: tuple[dt.date, dt.date] | None = None,
    run_ts: dt.datetime = DEFAULT_RUN_TS,
) -> Warehouse:
    tune(spark)
    root = root or _root_for(spark, sf_dir, calendar, input_state(spark, sf_dir))
    wh = Warehouse(spark, root, sf_dir, calendar, run_ts)
    from tillroll.plans.pipeline import run_pipeline

    feeds = {name: (lambda n=name: wh.feed(n)) for name in ingest.TABLE_ORDER}
    wh.last_run = run_pipeline(wh, feeds)
    fs.write_text(spark, f"{root}/_COMPLETE", wh.last_run.status)
    return wh


def register(wh: Warehouse) -> None:
    """Make ``wh`` the warehouse ``open_warehouse`` returns for its input."""
    state = input_state(wh.spark, wh.sf_dir)
    with _LOCK:
        _OPEN[(id(wh.spark), f"{wh.sf_dir}|{wh.calendar}")] = (state, wh)


def open_warehouse(
    spark: SparkSession,
    sf_dir: str,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> Warehouse:
    """The completed warehouse for ``sf_dir`` as its tables are now: built on first
    use, and again when an input table was replaced."""
    key = (id(spark), f"{sf_dir}|{calendar}")
    state = input_state(spark, sf_dir)
    with _LOCK:
        known, wh = _OPEN.get(key, (None, None))
        if known == state:
            return wh
        # an unfinished earlier attempt leaves uncommitted folders; a new
        # attempt goes to a fresh folder so nothing half-written is reused
        base = _root_for(spark, sf_dir, calendar, state)
        attempt, i = base, 0
        while fs.exists(spark, attempt) and not fs.exists(spark, f"{attempt}/_COMPLETE"):
            i += 1
            attempt = f"{base}-retry{i}"
        if fs.exists(spark, f"{attempt}/_COMPLETE"):
            wh = Warehouse(spark, attempt, sf_dir, calendar)
        else:
            wh = build(spark, sf_dir, attempt, calendar)
        if wh.status != "success":
            log.warning("the build of %s ended as %s; see audit.model_test_results", sf_dir, wh.status)
        _OPEN[key] = (state, wh)
        return wh


__all__ = ["Warehouse", "build", "build_marts", "ingest_table", "last_batch", "open_warehouse", "register"]
