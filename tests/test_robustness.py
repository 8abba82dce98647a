"""Input that isn't clean, typed, unchanging or in UTC: nothing is lost, mixed up
or answered from an older state."""

import ast
import datetime as dt
import json
import pathlib
import shutil
import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tillroll.functions.calendar import utc
from tillroll.functions.coerce import add_line_total, parse_date
from tillroll.plans import ingest, ledger
from tillroll.plans.feeds import file_feeds
from tillroll.plans.pipeline import ingest_all, run_pipeline
from tillroll.plans.queries import QUERIES
from tillroll.plans.warehouse import Warehouse, input_state, open_warehouse
from tillroll.schemas import CUSTOMERS, SPECS
from tillroll.session import shared_dir
from tillroll.sources import audit
from tillroll.sources.files import load_csv, load_json
from tillroll.sources.fixtures import SEQ
from tillroll.sources.overlay import overlay_products, products_input
from tillroll.sources.tables import TableStore
from tillroll.streaming import ingest_stream

SF = "/root/testdata/sf0.001"
RUN = dt.datetime(2024, 1, 1)


# -- readers -----------------------------------------------------------------

def test_json_behind_any_number_of_blanks(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text(" \n" * 5000 + json.dumps([{"payment_id": 1}]))
    assert load_json(spark, str(p)).count() == 1


def test_csv_quotes_commas_and_line_ends_inside_fields(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('id,name,note\n1,"He said ""hi"", ok",a\n2,"two\nlines","b, c"\n3,plain,d\n')
    rows = {r.id: (r.name, r.note, r._corrupt_record) for r in load_csv(spark, str(p)).collect()}
    assert rows == {"1": ('He said "hi", ok', "a", None), "2": ("two\nlines", "b, c", None), "3": ("plain", "d", None)}
    # read without line ends inside fields, such a row is marked, not shifted
    split = load_csv(spark, str(p), multi_line=False).collect()
    assert sum(r._corrupt_record is not None for r in split) == 2


def test_rows_shorter_than_the_header_are_valid(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('a,b,c\n1,"x, y"\n2\n3,4,5,6\n7,8,9\n')
    rows = {r.a: (r.b, r.c, r._corrupt_record is not None) for r in load_csv(spark, str(p)).collect()}
    assert rows["1"] == ("x, y", None, False) and rows["2"] == (None, None, False)
    assert rows["3"][2] and rows["7"] == ("8", "9", False)


def test_first_copy_follows_file_order_not_file_size(spark, tmp_path):
    d = tmp_path / "feed"
    d.mkdir()
    (d / "a.csv").write_text("store_id,store_name\n1,from a\n")
    (d / "b.csv").write_text("store_id,store_name\n1,from b\n" + "".join(f"{i},s{i}\n" for i in range(10, 20000)))
    kept = ingest.prepare(load_csv(spark, str(d)), "stores").where("store_id = 1").collect()
    assert [r.store_name for r in kept] == ["from a"]


def test_files_of_one_feed_must_agree_on_the_header(spark, tmp_path):
    d = tmp_path / "feed"
    d.mkdir()
    (d / "a.csv").write_text("store_id,store_name\n1,a\n")
    (d / "b.csv").write_text("store_name,store_id\nb,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(d)).collect()


def test_json_lines_through_the_feed_folder(spark, tmp_path):
    for name, spec in SPECS.items():
        if name == "payments":
            (tmp_path / "payments.jsonl").write_text('{"payment_id": 1, "order_id": 2, "amount": "3.5", "payment_status": "success"}\n')
        else:
            (tmp_path / f"{name}.csv").write_text(",".join(spec.required_columns) + "\n")
    feeds, labels = file_feeds(spark, str(tmp_path))
    row = ingest.prepare(feeds["payments"](), "payments").first()
    assert labels["payments"] == "jsonl:payments.jsonl" and row.payment_id == 1 and str(row.amount) == "3.50"


def test_overlay_orders_an_enveloped_extract_by_number(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,product_name,price\n1,snapshot,1\n")
    (tmp_path / "api.json").write_text(json.dumps({"data": [{"id": "1", "title": f"T{i}", "price": str(i)} for i in range(11)]}))
    out = overlay_products(load_csv(spark, str(tmp_path / "p.csv")), load_json(spark, str(tmp_path / "api.json"))).collect()
    assert [r.product_name for r in out] == ["T10"]


def test_fallback_hides_no_fault_of_the_overlay(spark, tmp_path, caplog):
    snapshot = spark.createDataFrame([(1, "a", 1.0, (1,))], f"product_id long, product_name string, price double, {SEQ} struct<p:int>")
    df, label = products_input(lambda: snapshot, lambda: load_json(spark, str(tmp_path / "none.json")))
    assert label == "csv:products.csv" and df.count() == 1 and "can't be read" in caplog.text
    wrong = spark.createDataFrame([(1, "b", 2.0, "x")], f"id long, title string, price double, {SEQ} string")
    with pytest.raises(ValueError):
        products_input(lambda: snapshot, lambda: wrong)


# -- cleaning ----------------------------------------------------------------

def test_rows_with_different_bad_ids_are_all_rejected_with_their_text(spark):
    feed = spark.createDataFrame([("abc", "A", (1,)), ("def", "B", (2,)), ("def", "again", (3,)), ("7", "C", (4,)), ("7.0", "D", (5,))],
                                 f"store_id string, store_name string, {SEQ} struct<p:int>")
    tagged = ingest.prepare(feed, "stores").cache()
    bad = tagged.where("size(_reasons) > 0")
    assert sorted(r.store_name for r in bad.collect()) == ["A", "B"]
    assert [r.store_name for r in tagged.where("size(_reasons) = 0").collect()] == ["C"]
    records = [json.loads(r.record_data) for r in audit.rejected_records(bad, "s", "stores", SPECS["stores"].column_names, RUN).collect()]
    assert sorted(r["store_id"] for r in records) == ["abc", "def"]


def test_text_behind_a_date_is_no_date(spark):
    values = ["2024-01-01 garbage", "2024-01-01", " 2024-01-01 ", "2024-01-01T10:00:00Z", "2024-01-01 10:00", "1/2/2024", "2024-02-30", "x", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.d for r in df.select(parse_date("v").alias("d")).collect()]
    day = dt.date(2024, 1, 1)
    assert got == [None, day, day, day, day, dt.date(2024, 1, 2), None, None, None]


def test_a_line_too_large_for_the_models_is_rejected_not_fatal(spark):
    feed = spark.createDataFrame([("1", "1", "1", "2000000000", "9999999999.99", "0", (1,)), ("2", "1", "1", "2", "3.50", "1", (2,))],
                                 f"order_item_id string, order_id string, product_id string, quantity string, unit_price string, discount string, {SEQ} struct<p:int>")
    rows = {r.order_item_id: r._reason for r in ingest.prepare(feed, "order_items").collect()}
    assert rows == {1: "quantity * unit_price is out of range", 2: None}
    big = spark.sql("select 2000000000 quantity, cast(9999999999.99 as decimal(12,2)) unit_price, cast(0 as decimal(12,2)) discount")
    assert str(add_line_total(big).first().line_total) == "19999999999980000000.00"


# -- time --------------------------------------------------------------------

@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/Los_Angeles"])
def test_results_do_not_depend_on_the_drivers_zone(spark, tmp_path, monkeypatch, zone):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        assert spark.range(1).select(utc(RUN).cast("string").alias("t")).first().t == "2024-01-01 00:00:00"
        orders = spark.read.parquet(f"{SF}/orders.parquet")
        late = orders.where("cast(o_orderdate as timestamp) > timestamp'1999-01-01 00:00:00' and o_orderkey % 50 <> 11")
        assert QUERIES["incremental_orders"](spark, SF).count() == late.select("o_orderkey").distinct().count()
        store = TableStore(spark, str(tmp_path / "s"))
        run = ledger.start_pipeline_run(store, "p", None, at=RUN)
        ledger.finish_pipeline_run(store, run, "success", 1, watermark_end=dt.datetime(2024, 1, 1, 5), at=RUN)
        assert ledger.get_last_successful_watermark(store, "p") == dt.datetime(2024, 1, 1, 5, tzinfo=dt.timezone.utc)
    finally:
        monkeypatch.undo()
        time.tzset()


# -- store -------------------------------------------------------------------

CUSTOMER = "customer_id long, first_name string, last_name string, email string, signup_date date"


def _people(spark, rows):
    return spark.createDataFrame([(i, f"F{i}", last, f"e{i}@x", dt.date(2024, 1, 1)) for i, last in rows], CUSTOMER).coalesce(1)


def _upsert(store, df, **more):
    return store.upsert(df, "customers", ["customer_id"], CUSTOMERS.struct(), RUN, **more)


def test_upsert_last_copy_wins_and_an_empty_batch_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    _upsert(store, _people(spark, [(1, "a"), (2, "b"), (1, "c")]))
    out = _upsert(store, _people(spark, [(2, "d"), (3, "e"), (2, "f")]))
    assert {r.customer_id: r.last_name for r in out.collect()} == {1: "c", 2: "f", 3: "e"} and out.count() == 3
    versions = store.versions("raw", "customers")
    _upsert(store, _people(spark, [(1, "x")]).limit(0))
    assert store.versions("raw", "customers") == versions
    ordered = _people(spark, [(4, "late"), (4, "early")]).withColumn("at", F.when(F.col("last_name") == "late", 2).otherwise(1))
    assert _upsert(store, ordered, order="at").where("customer_id = 4").first().last_name == "late"


def test_a_small_upsert_does_not_shuffle_the_table(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    _upsert(store, _people(spark, [(i, "a") for i in range(1000)]))
    plans = []
    write = store.write
    monkeypatch.setattr(store, "write", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k))[1])
    _upsert(store, _people(spark, [(5, "b"), (2000, "c"), (2001, "d")]))
    target = plans[0].split("Union")[1].split("customer_id")[0] if "Union" in plans[0] else plans[0]
    assert "SortMergeJoin" not in plans[0] and "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning" not in target


def test_append_writes_the_batch_alone_and_versions_expire(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load(_people(spark, [(1, "a")]), "customers", "replace")
    store.load(_people(spark, [(2, "b")]), "customers")
    store.load(_people(spark, [(3, "c")]).drop("email"), "customers")
    assert sorted(r.customer_id for r in store.read("raw", "customers").collect()) == [1, 2, 3]
    assert spark.read.parquet(store.current_path("raw", "customers")).count() == 1
    assert sorted(r.customer_id for r in TableStore(spark, str(tmp_path)).read("raw", "customers").collect()) == [1, 2, 3]
    assert store.expire("raw", "customers", 1) == []  # the newest version needs all three
    store.load(_people(spark, [(9, "z")]), "customers", "replace")
    store.load(_people(spark, [(1, "a")]).limit(0), "customers", "replace")
    assert [r.customer_id for r in store.read("raw", "customers").collect()] == [9]
    assert store.expire("raw", "customers", 1) == [1, 2, 3] and store.read("raw", "customers").count() == 1


def test_runs_that_start_together_get_different_ids(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        ids = list(pool.map(lambda _: ledger.start_pipeline_run(store, "p", None, at=RUN), range(6)))
    assert len(set(ids)) == 6
    assert ledger.pipeline_runs(store.read_appended("audit", ledger.LEDGER)).count() == 6


def test_no_method_is_defined_twice():
    for f in pathlib.Path(__file__).resolve().parents[1].glob("tillroll/**/*.py"):
        for node in ast.walk(ast.parse(f.read_text())):
            if isinstance(node, (ast.ClassDef, ast.Module)):
                names = [n.name for n in node.body if isinstance(n, (ast.FunctionDef, ast.ClassDef)) and not n.decorator_list]
                assert len(names) == len(set(names)), f


# -- pipeline ----------------------------------------------------------------

def test_a_replaced_input_is_built_anew(spark, tmp_path):
    for t in pathlib.Path(SF).glob("*.parquet"):
        if t.stem in ("customer", "supplier", "nation", "region", "part", "orders", "lineitem", "events"):
            shutil.copy(t, tmp_path / t.name)
    first = open_warehouse(spark, str(tmp_path))
    before = first.fact.count()
    assert open_warehouse(spark, str(tmp_path)) is first
    state = input_state(spark, str(tmp_path))
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(100).coalesce(1).write.parquet(str(tmp_path / "less"))
    (tmp_path / "lineitem.parquet").unlink()
    shutil.copy(next((tmp_path / "less").glob("*.parquet")), tmp_path / "lineitem.parquet")
    assert input_state(spark, str(tmp_path)) != state
    second = open_warehouse(spark, str(tmp_path))
    assert second.fact.count() <= 100 < before and second.status in ("success", "failed")


def test_streams_of_one_store_keep_each_others_rejects(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    for k, bad in (("one", "x"), ("two", "y")):
        d = tmp_path / k
        d.mkdir()
        (d / "f.csv").write_text(f"order_id,customer_id,store_id,order_date,order_status\n{1 if k == 'one' else 2},1,,2024-01-01,\n{bad},1,,2024-01-01,placed\n")
        ingest_stream(spark, store, "orders", str(d), str(tmp_path / f"ckpt-{k}"), run_ts=RUN)
    rejects = spark.read.parquet(store.path("audit", "rejected_records"))
    assert sorted(json.loads(r.record_data)["order_id"] for r in rejects.collect()) == ["x", "y"]
    assert store.read("raw", "orders").count() == 2


def test_a_stream_refuses_files_with_another_header(spark, tmp_path):
    d = tmp_path / "feed"
    d.mkdir()
    (d / "f.csv").write_text("customer_id,order_id,store_id,order_date,order_status\n1,2,3,2024-01-01,placed\n")
    store = TableStore(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception, match="(?i)header"):
        ingest_stream(spark, store, "orders", str(d), str(tmp_path / "ckpt"), run_ts=RUN)
    assert not store.exists("raw", "orders")


def test_empty_feeds_load_nothing_and_stop_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), SF, run_ts=RUN)
    empty = {n: (lambda n=n: wh.feed(n).limit(0)) for n in ingest.TABLE_ORDER}
    rows = {r.table_name: (r.rows_loaded, r.rows_rejected) for r in ingest_all(wh, empty).collect()}
    assert set(rows.values()) == {(0, 0)} and wh.raw("stores").count() == 0
    full = {n: (lambda n=n: wh.feed(n)) for n in ingest.TABLE_ORDER}
    ingest_all(wh, full)
    loaded, versions = wh.raw("orders").count(), wh.store.versions("raw", "orders")
    ingest_all(wh, empty)
    assert loaded > 0 and wh.raw("orders").count() == loaded and wh.store.versions("raw", "orders") == versions


def test_the_whole_error_is_recorded(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), SF, run_ts=RUN)
    text = "x" * 5000

    def broken():
        raise ValueError(text)

    with pytest.raises(ValueError):
        run_pipeline(wh, {n: broken for n in ingest.TABLE_ORDER})
    run = ledger.pipeline_runs(wh.store.read_appended("audit", ledger.LEDGER)).first()
    assert run.status == "failed" and run.error_message == text


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))
