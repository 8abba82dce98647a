"""Upsert idempotency, column-preserving merge, ledger and watermark."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.plans import ledger
from tillroll.schemas import CUSTOMERS
from tillroll.sources.tables import TableStore

ROW = "customer_id long, first_name string, last_name string, email string, city string, signup_date date"


def _store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "wh"))


def test_upsert_twice_is_one_row(spark, tmp_path):
    store = _store(spark, tmp_path)
    batch = spark.createDataFrame([(1, "A", "B", "a@x", "X", dt.date(2024, 1, 1))], ROW)
    for i in range(2):
        store.upsert(batch, "customers", ["customer_id"], CUSTOMERS.struct(), dt.datetime(2024, 1, 1 + i))
    out = store.read("raw", "customers")
    assert out.count() == 1
    r = out.first()
    assert r.created_at == dt.datetime(2024, 1, 1) and r.updated_at == dt.datetime(2024, 1, 2)


def test_upsert_keeps_columns_absent_from_batch(spark, tmp_path):
    store = _store(spark, tmp_path)
    first = spark.createDataFrame([(1, "A", "B", "a@x", "X", dt.date(2024, 1, 1)),
                                   (2, "C", "D", "c@x", "Y", dt.date(2024, 1, 1))], ROW)
    store.upsert(first, "customers", ["customer_id"], CUSTOMERS.struct(), dt.datetime(2024, 1, 1))
    second = spark.createDataFrame([(1, "A", "B2", None, dt.date(2024, 1, 1)), (3, "E", "F", "e@x", dt.date(2024, 1, 1))],
                                   "customer_id long, first_name string, last_name string, email string, signup_date date")
    store.upsert(second, "customers", ["customer_id"], CUSTOMERS.struct(), dt.datetime(2024, 1, 2))
    rows = {r.customer_id: r for r in store.read("raw", "customers").collect()}
    assert rows[1].last_name == "B2" and rows[1].city == "X"  # city not in batch: kept
    assert rows[1].email is None  # a null in the batch does overwrite
    assert rows[2].last_name == "D" and rows[3].city is None
    assert len(store.versions("raw", "customers")) == 2


def test_load_append_replace_truncate(spark, tmp_path):
    store = _store(spark, tmp_path)
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert store.load(df, "t", "replace").count() == 2
    assert store.load(df, "t", "append").count() == 4
    store.truncate("t")
    assert store.read("raw", "t").count() == 0


def test_ledger_watermark_moves_after_success(spark, tmp_path):
    store = _store(spark, tmp_path)
    assert ledger.get_last_successful_watermark(store, "p") is None
    r1 = ledger.start_pipeline_run(store, "p", None, at=dt.datetime(2024, 1, 1))
    ledger.finish_pipeline_run(store, r1, "success", 10, watermark_end=dt.datetime(2024, 1, 1, 1),
                               at=dt.datetime(2024, 1, 1, 1))
    assert ledger.get_last_successful_watermark(store, "p") == dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc)
    r2 = ledger.start_pipeline_run(store, "p", dt.datetime(2024, 1, 1, 1), at=dt.datetime(2024, 1, 2))
    ledger.finish_pipeline_run(store, r2, "failed", at=dt.datetime(2024, 1, 2, 1))
    assert ledger.get_last_successful_watermark(store, "p") == dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc)
    runs = {r.run_id: r for r in ledger.pipeline_runs(ledger._events(store)).collect()}
    assert runs[r2].status == "failed" and runs[r2].watermark_start == dt.datetime(2024, 1, 1, 1)


def test_ledger_rejects_bad_status(spark, tmp_path):
    import pytest

    store = _store(spark, tmp_path)
    with pytest.raises(ValueError):
        ledger.finish_pipeline_run(store, 1, "running")


def test_incremental_filter_reaches_scan(spark, tmp_path):
    p = str(tmp_path / "o")
    spark.createDataFrame([(1, dt.datetime(1998, 1, 1)), (2, dt.datetime(2000, 1, 1))],
                          "order_id long, updated_at timestamp").write.parquet(p)
    df = ledger.incremental(spark.read.parquet(p), dt.datetime(1999, 1, 1))
    assert [r.order_id for r in df.collect()] == [2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "updated_at" in plan
    assert F  # keep import used


def test_upsert_large_batch_path_matches_small_batch_path(spark, tmp_path):
    base = spark.createDataFrame([(i, f"F{i}", f"L{i}", f"e{i}@x", f"C{i}", dt.date(2024, 1, 1)) for i in range(20)], ROW)
    batch = spark.createDataFrame(
        [(i, f"F{i}", f"L{i}-v2", f"e{i}@x", dt.date(2024, 1, 2)) for i in range(10, 30)],
        "customer_id long, first_name string, last_name string, email string, signup_date date")
    results = []
    for bound in (None, "0"):
        if bound:
            spark.conf.set("tillroll.broadcast.maxBytes", bound)  # batch keys "too big": full outer path
        try:
            store = TableStore(spark, str(tmp_path / f"wh{bound}"))
            store.upsert(base, "customers", ["customer_id"], CUSTOMERS.struct(), dt.datetime(2024, 1, 1))
            out = store.upsert(batch, "customers", ["customer_id"], CUSTOMERS.struct(), dt.datetime(2024, 1, 2))
            results.append(sorted(tuple(r) for r in out.collect()))
        finally:
            spark.conf.unset("tillroll.broadcast.maxBytes")
    assert results[0] == results[1]
    rows = {r[0]: r for r in results[0]}
    assert len(rows) == 30 and rows[15][2] == "L15-v2" and rows[15][5] == "C15" and rows[25][5] is None
    assert rows[5][2] == "L5"
