"""End to end from feed files: ingest -> gate -> marts -> tests -> ledger."""

import json

from pyspark.sql import functions as F

from tillroll.plans import ledger
from tillroll.plans.feeds import file_feeds
from tillroll.plans.pipeline import run_pipeline
from tillroll.plans.warehouse import Warehouse
import datetime as dt


def _write(d):
    (d / "customers.csv").write_text(
        "customer_id,first_name,last_name,email,phone,city,state,country,signup_date\n"
        "1, Ann ,Lee, A@X.com ,,Pune,MH,IN,2024-01-05\n"
        "1,Dup,Dup,d@x.com,,,,,2024-01-05\n"
        "2,Bob,Ray,,,,,,2024-02-01\n"
        "3,Cy,Oh,c@x.com,,,,,not-a-date\n")
    (d / "stores.csv").write_text("store_id,store_name,city,state,country\n1,Main,Pune,MH,IN\n2,,X,,\n")
    (d / "products.csv").write_text(
        "product_id,product_name,category,price,store_id\n10,Pen,Office,2.50,1\n11,Ink,,1.00,1\n12,Bad,Office,-1,1\n")
    (d / "products_api.json").write_text(json.dumps({"data": [{"id": 11, "title": "Ink Pro", "price": 1.5}]}))
    (d / "orders.csv").write_text(
        "order_id,customer_id,store_id,order_date,order_status\n"
        "100,1,1,2024-03-01,placed\n101,1,,2024-03-02,\n102,9,1,31-31-2026,placed\n")
    (d / "order_items.csv").write_text(
        "order_item_id,order_id,product_id,quantity,unit_price,discount\n"
        "1,100,10,2,2.50,0.50\n2,100,11,1,1.50,0\n3,101,10,-1,2.50,0\n4,101,10,1,2.50,9\n5,101,11,3,1.50,\n")
    (d / "payments.json").write_text(json.dumps([
        {"payment_id": 1, "order_id": 100, "payment_method": "card", "amount": 5.0, "payment_status": "failed",
         "payment_date": "2024-03-01"},
        {"payment_id": 2, "order_id": 100, "payment_method": "card", "amount": 5.0, "payment_status": "success",
         "payment_date": "2024-03-02"},
        {"payment_id": 3, "order_id": 101, "payment_method": "cash", "amount": 1.0, "payment_status": "weird",
         "payment_date": None},
    ]))


def test_pipeline_from_files(spark, tmp_path):
    feed_dir = tmp_path / "feeds"
    feed_dir.mkdir()
    _write(feed_dir)
    wh = Warehouse(spark, str(tmp_path / "wh"), str(feed_dir), calendar=(dt.date(2024, 1, 1), dt.date(2024, 12, 31)))
    feeds, labels = file_feeds(spark, str(feed_dir))
    res = run_pipeline(wh, feeds, sources=labels)
    assert res.gate_passed
    raw = {n: wh.raw(n) for n in ("customers", "stores", "products", "orders", "order_items", "payments")}
    assert [r.customer_id for r in raw["customers"].collect()] == [1]  # dup dropped, null email / bad date rejected
    c = raw["customers"].first()
    assert (c.first_name, c.email, c.city) == ("Ann", "a@x.com", "Pune")
    assert raw["stores"].count() == 1
    # overlay path: snapshot cut to required columns, extract wins for id 11
    prods = {r.product_id: r for r in raw["products"].collect()}
    assert sorted(prods) == [10, 11] and prods[11].product_name == "Ink Pro" and prods[10].category is None
    assert sorted(r.order_id for r in raw["orders"].collect()) == [100, 101]
    assert sorted(r.order_item_id for r in raw["order_items"].collect()) == [1, 2]
    assert [r.payment_id for r in raw["payments"].orderBy("payment_id").collect()] == [1, 2]
    fact = wh.fact.orderBy("sale_id").collect()
    assert [(r.sale_id, r.order_item_id, str(r.total_amount), r.payment_status) for r in fact] == [
        (1, 1, "4.50", "success"), (2, 2, "1.50", "success")]
    rej = {(r.table_name, r.reason) for r in wh.rejected().collect()}
    assert ("order_items", "quantity must be greater than 0") in rej
    assert ("order_items", "discount must not be negative") in rej  # empty discount is null -> rejected
    assert ("payments", "payment_status must be one of ['failed', 'pending', 'refunded', 'success']") in rej
    assert ("stores", "missing store_id or store_name") in rej
    runs = ledger.pipeline_runs(wh.store.read_appended("audit", "pipeline_events")).collect()
    assert len(runs) == 1 and runs[0].status == res.status
    tests = wh.store.read_appended("audit", "model_test_results")
    assert tests.filter(F.col("test_name") == "assert_valid_orders").first().failures == 1  # order 101 has no line


def test_ingest_quality_transform_steps(spark, tmp_path):
    from tillroll.plans.pipeline import ingest_all, run_quality, transform

    feed_dir = tmp_path / "feeds"
    feed_dir.mkdir()
    _write(feed_dir)
    wh = Warehouse(spark, str(tmp_path / "wh"), str(feed_dir), calendar=(dt.date(2024, 1, 1), dt.date(2024, 12, 31)))
    feeds, labels = file_feeds(spark, str(feed_dir))
    summary = {r.table_name: (r.rows_loaded, r.rows_rejected) for r in ingest_all(wh, feeds, labels).collect()}
    assert summary["customers"] == (1, 2) and summary["order_items"] == (2, 3)
    assert run_quality(wh) is True
    assert ledger.get_last_successful_watermark(wh.store, "adhoc-quality-check") is None  # no watermark recorded
    transform(wh)
    assert wh.fact.count() == 2


def test_bad_api_extract_falls_back_to_snapshot(spark, tmp_path):
    feed_dir = tmp_path / "feeds"
    feed_dir.mkdir()
    _write(feed_dir)
    (feed_dir / "products_api.json").write_text("{not json")
    feeds, labels = file_feeds(spark, str(feed_dir))
    df = feeds["products"]()
    assert labels["products"] == "csv:products.csv"
    assert sorted(r.product_id for r in df.select("product_id").collect()) == ["10", "11", "12"]
    assert "category" in df.columns  # snapshot path keeps every column


def test_catalog_after_an_upsert(spark, tmp_path):
    from tillroll.plans.catalog import register_catalog
    from tillroll.plans.pipeline import ingest_all, transform

    feed_dir = tmp_path / "feeds"
    feed_dir.mkdir()
    _write(feed_dir)
    wh = Warehouse(spark, str(tmp_path / "wh"), str(feed_dir), calendar=(dt.date(2024, 1, 1), dt.date(2024, 12, 31)))
    feeds, labels = file_feeds(spark, str(feed_dir))
    ingest_all(wh, feeds, labels)
    (feed_dir / "customers.csv").write_text(
        "customer_id,first_name,last_name,email,signup_date\n1,Ann,Lee-Ray,a@x.com,2024-01-05\n4,Dee,Fox,d@x.com,2024-02-02\n")
    feeds, labels = file_feeds(spark, str(feed_dir))
    ingest_all(wh, {**feeds}, labels)  # second batch of every feed: merged versions
    transform(wh)
    register_catalog(spark, wh)
    rows = {r.customer_id: r for r in spark.sql("select * from raw.customers").collect()}
    assert sorted(rows) == [1, 4] and rows[1].last_name == "Lee-Ray" and rows[1].city == "Pune"
    assert spark.sql("select count(*) as n from warehouse.fact_sales").first().n == 2


def test_pipeline_twice_is_idempotent_and_moves_the_watermark(spark, tmp_path):
    feed_dir = tmp_path / "feeds"
    feed_dir.mkdir()
    _write(feed_dir)
    cal = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    first = Warehouse(spark, str(tmp_path / "wh"), str(feed_dir), calendar=cal, run_ts=dt.datetime(2024, 6, 1))
    feeds, labels = file_feeds(spark, str(feed_dir))
    r1 = run_pipeline(first, feeds, sources=labels)
    snap = {n: sorted(tuple(x) for x in first.raw(n).drop("created_at", "updated_at").collect())
            for n in ("customers", "orders", "order_items", "payments", "products", "stores")}
    fact1 = sorted(tuple(x) for x in first.fact.drop("created_at").collect())
    second = Warehouse(spark, str(tmp_path / "wh"), str(feed_dir), calendar=cal, run_ts=dt.datetime(2024, 6, 2))
    feeds, labels = file_feeds(spark, str(feed_dir))
    r2 = run_pipeline(second, feeds, sources=labels)
    assert r2.run_id == r1.run_id + 1
    for n, rows in snap.items():
        assert sorted(tuple(x) for x in second.raw(n).drop("created_at", "updated_at").collect()) == rows, n
    assert sorted(tuple(x) for x in second.fact.drop("created_at").collect()) == fact1
    runs = {r.run_id: r for r in ledger.pipeline_runs(second.store.read_appended("audit", "pipeline_events")).collect()}
    assert runs[r2.run_id].watermark_start == dt.datetime(2024, 6, 1) or r1.status != "success"
    c = second.raw("customers").first()
    assert c.created_at == dt.datetime(2024, 6, 1) and c.updated_at == dt.datetime(2024, 6, 2)
