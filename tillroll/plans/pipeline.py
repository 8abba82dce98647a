"""End-to-end run with the quality gate (G-5).

ledger start -> ingest every feed -> raw-layer checks (stop on a critical
failure) -> staging + marts -> model tests -> ledger finish. Check and test
results are appended to the audit layer; any exception finishes the run as
failed with its message.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans import checks, ingest, ledger, model_tests
from tillroll.sources import audit


class PipelineGateError(RuntimeError):
    """Critical raw-layer quality checks failed."""


@dataclass
class RunResult:
    run_id: int
    status: str
    records_processed: int
    gate_passed: bool
    tests_passed: bool
    timings: dict | None = None


def run_pipeline(
    wh,
    feeds: Mapping[str, Callable[[], DataFrame]],
    pipeline_name: str = "full-pipeline",
    sources: Mapping[str, str] | None = None,
) -> RunResult:
    from tillroll.plans.warehouse import build_marts, ingest_table  # cyclic at import time

    timings: dict[str, float] = {}
    clock = [time.time()]

    def lap(phase: str) -> None:
        now = time.time()
        timings[phase] = round(now - clock[0], 3)
        clock[0] = now

    store = wh.store
    wm_start = ledger.get_last_successful_watermark(store, pipeline_name)
    run_id = ledger.next_run_id(store)
    lap("ledger_start")
    try:
        # the six feeds and the run's start event are independent jobs: submit
        # them concurrently (events carry their own timestamps)
        with ThreadPoolExecutor(max_workers=len(ingest.TABLE_ORDER) + 1) as pool:
            started = pool.submit(ledger.record_start, store, run_id, pipeline_name, wm_start, wh.run_ts)

            def one(name: str) -> int:
                t0 = time.time()
                df = feeds[name]()
                rows, _ = ingest_table(wh, name, df, (sources or {}).get(name, f"fixture:{name}"))
                timings[f"ingest.{name}"] = round(time.time() - t0, 3)
                return rows

            futures = [pool.submit(one, name) for name in ingest.TABLE_ORDER]
            started.result()
            loaded = sum(f.result() for f in futures)
        lap("ingest")
        wh.cluster_orders()
        lap("cluster")

        results = checks.quality_checks(wh.raw)
        store.append(audit.quality_results(results, run_id, wh.run_ts), "audit", "data_quality_results", part=str(run_id))
        gate = checks.gate_passed(
            store.read_appended("audit", "data_quality_results").filter(F.col("pipeline_run_id") == run_id)
        )
        lap("quality_gate")
        if not gate:
            ledger.finish_pipeline_run(store, run_id, "failed", loaded, at=wh.run_ts)
            raise PipelineGateError("critical data quality checks failed")

        def run_unit(units: dict, part: str) -> None:
            df = units[part]().withColumn("pipeline_run_id", F.lit(run_id).cast("long"))
            store.append(df, "audit", "model_test_results", part=f"{run_id}-{part}")

        groups = model_tests.test_groups()
        staging_models = models_of(wh, marts=False)
        stg_units = {m: (lambda ts=ts: model_tests.run_model_tests(staging_models, ts, singular=False))
                     for m, ts in groups.items() if m.startswith("stg_")}
        # tests of different models are independent jobs: the staging tests only
        # read bronze, so they run while the dimensions and the fact are built
        with ThreadPoolExecutor(max_workers=8) as pool:
            pending = [pool.submit(run_unit, stg_units, u) for u in stg_units]
            build_marts(wh, lap)
            models = models_of(wh)
            mart_units = {m: (lambda ts=ts: model_tests.run_model_tests(models, ts, singular=False))
                          for m, ts in groups.items() if not m.startswith("stg_")}
            mart_units["singular"] = lambda: model_tests.run_singular_tests(models)
            pending += [pool.submit(run_unit, mart_units, u) for u in mart_units]
            for f in pending:
                f.result()
        failed = (
            store.read_appended("audit", "model_test_results")
            .filter((F.col("pipeline_run_id") == run_id) & (F.col("status") == "fail"))
            .limit(1).count()
        )
        lap("model_tests")
        status = "success" if failed == 0 else "failed"
        ledger.finish_pipeline_run(store, run_id, status, loaded, watermark_end=wh.run_ts, at=wh.run_ts)
        lap("ledger")
        return RunResult(run_id, status, loaded, True, failed == 0, timings)
    except PipelineGateError:
        raise
    except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
        ledger.finish_pipeline_run(store, run_id, "failed", error_message=str(exc), at=wh.run_ts)
        raise


def models_of(wh, marts: bool = True) -> dict[str, DataFrame]:
    stg = wh.stg()
    out = {f"stg_{k}": v for k, v in stg.items()}
    if marts:
        for d in ("customer", "product", "store", "date"):
            out[f"dim_{d}"] = wh.dim(d)
        out["fact_sales"] = wh.fact
    return out


def ingest_all(wh, feeds: Mapping[str, Callable[[], DataFrame]], sources: Mapping[str, str] | None = None) -> DataFrame:
    """The ``ingest`` step alone: every feed, concurrently; returns the
    (table_name, rows_loaded, rows_rejected) summary of the batches."""
    from tillroll.plans.warehouse import ingest_table

    with ThreadPoolExecutor(max_workers=len(ingest.TABLE_ORDER)) as pool:
        futures = {
            n: pool.submit(lambda n=n: ingest_table(wh, n, feeds[n](), (sources or {}).get(n, f"feed:{n}")))
            for n in ingest.TABLE_ORDER
        }
        rows = [(n, *f.result()) for n, f in futures.items()]
    return wh.spark.createDataFrame(rows, "table_name string, rows_loaded long, rows_rejected long")


def run_quality(wh, pipeline_name: str = "adhoc-quality-check") -> bool:
    """The ``quality`` step alone: a ledger run around the raw-layer checks.
    Like the reference, it records success without a watermark_end."""
    store = wh.store
    wm = ledger.get_last_successful_watermark(store, pipeline_name)
    run_id = ledger.start_pipeline_run(store, pipeline_name, wm, at=wh.run_ts)
    results = checks.quality_checks(wh.raw)
    store.append(audit.quality_results(results, run_id, wh.run_ts), "audit", "data_quality_results", part=str(run_id))
    passed = checks.gate_passed(
        store.read_appended("audit", "data_quality_results").filter(F.col("pipeline_run_id") == run_id)
    )
    ledger.finish_pipeline_run(store, run_id, "success" if passed else "failed", at=wh.run_ts)
    return passed


def transform(wh) -> None:
    """The ``transform`` step alone: staging views, dimensions and the fact."""
    from tillroll.plans.warehouse import build_marts

    wh.cluster_orders()
    build_marts(wh)
