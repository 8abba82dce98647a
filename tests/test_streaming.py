"""Incremental file loads: only new files are read; updates upsert by key."""

import datetime as dt

from tillroll.sources.tables import TableStore
from tillroll.streaming import ingest_stream

HEADER = "order_id,customer_id,store_id,order_date,order_status\n"


def test_incremental_stream_loads_only_new_files(spark, tmp_path):
    feed = tmp_path / "orders"
    feed.mkdir()
    (feed / "a.csv").write_text(HEADER + "1,10,1,2024-01-01,placed\n2,11,,31-31-2026,placed\n")
    store = TableStore(spark, str(tmp_path / "wh"))
    ckpt = str(tmp_path / "ckpt")
    assert ingest_stream(spark, store, "orders", str(feed), ckpt, run_ts=dt.datetime(2024, 1, 1)) == 1
    assert [r.order_id for r in store.read("raw", "orders").collect()] == [1]
    # nothing new: no batch
    assert ingest_stream(spark, store, "orders", str(feed), ckpt, run_ts=dt.datetime(2024, 1, 2)) == 0
    (feed / "b.csv").write_text(HEADER + "1,10,1,2024-01-01,shipped\n3,12,NA,2024-01-03,\n")
    assert ingest_stream(spark, store, "orders", str(feed), ckpt, run_ts=dt.datetime(2024, 1, 3)) == 1
    rows = {r.order_id: r for r in store.read("raw", "orders").collect()}
    assert sorted(rows) == [1, 3]
    assert rows[1].order_status == "shipped" and rows[1].created_at == dt.datetime(2024, 1, 1)
    assert rows[3].store_id is None and rows[3].order_status is None
    rej = store.read_appended("audit", "rejected_records").collect()
    assert [r.reason for r in rej] == ["null in required column order_date"]


def test_incremental_stream_json_lines(spark, tmp_path):
    feed = tmp_path / "payments"
    feed.mkdir()
    (feed / "a.json").write_text(
        '{"payment_id": 1, "order_id": 10, "amount": 5.5, "payment_status": "success", "payment_date": "2024-01-02"}\n'
        '{"payment_id": 2, "order_id": 10, "amount": -1, "payment_status": "success"}\n'
        '{"payment_id": 3, "order_id": 11, "amount": 2, "payment_status": "bogus"}\n')
    store = TableStore(spark, str(tmp_path / "wh"))
    n = ingest_stream(spark, store, "payments", str(feed), str(tmp_path / "ckpt"), fmt="json",
                      run_ts=dt.datetime(2024, 1, 1))
    assert n == 1
    rows = store.read("raw", "payments").collect()
    assert [(r.payment_id, str(r.amount), r.payment_date) for r in rows] == [(1, "5.50", dt.date(2024, 1, 2))]
    reasons = sorted(r.reason for r in store.read_appended("audit", "rejected_records").collect())
    assert reasons == ["amount must not be negative",
                       "payment_status must be one of ['failed', 'pending', 'refunded', 'success']"]
