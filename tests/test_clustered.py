"""Copies on order_id: joins and groupings without an exchange, same results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.operators.joins import CONF_KEY
from tillroll.plans import checks, marts, staging
from tillroll.plans.warehouse import open_warehouse
from tillroll.sources import clustered
from tillroll.sources.tables import TableStore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return open_warehouse(spark, SF)


@pytest.fixture
def nothing_fits(spark):
    """Small tables would be broadcast; then no plan joins on order_id."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(CONF_KEY, "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset(CONF_KEY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df, column="order_id") -> list[str]:
    return [x for x in _plan(df).splitlines() if "Exchange hashpartitioning" in x and f"hashpartitioning({column}#" in x]


def test_the_copy_has_the_rows_of_its_version(spark, wh):
    for name in ("orders", "order_items", "payments"):
        copy, plain = wh.raw(name), wh.store.read("raw", name)
        assert sorted(copy.columns) == sorted(plain.columns)
        assert copy.select(plain.columns).exceptAll(plain).count() == 0 and copy.count() == plain.count()
        assert f"Bucketed: true" in _plan(copy.groupBy("order_id").count())


def test_per_order_models_and_checks_need_no_exchange(spark, wh, nothing_fits):
    stg = wh.stg()
    metrics = marts.int_order_metrics(stg["order_items"])
    assert not _exchanges(metrics)
    assert not _exchanges(marts.int_customer_orders(stg["orders"], metrics))
    assert not _exchanges(marts.latest_payment(stg["payments"]))
    assert not _exchanges(checks.failing_rows(wh.raw))


def test_the_fact_joins_order_lines_in_place(spark, wh, nothing_fits):
    """With dimensions that can't be broadcast the order side moves by their keys and so
    back; the lines and the payments, the large sides, never do."""
    spark.conf.unset(CONF_KEY)
    dims = {k: wh.dim(k) for k in ("customer", "product", "store", "date")}
    lines = marts.fact_lines(wh.stg(), dims, dt.datetime(2024, 1, 1))
    assert not _exchanges(lines) and "SortMergeJoin [order_id" in _plan(lines)


def test_results_equal_those_without_copies(spark, wh, nothing_fits):
    plain = staging.staging(lambda n: wh.store.read("raw", n))
    a = marts.int_customer_orders(wh.stg()["orders"], marts.int_order_metrics(wh.stg()["order_items"]))
    b = marts.int_customer_orders(plain["orders"], marts.int_order_metrics(plain["order_items"]))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_buckets_follow_partitions_and_size(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        assert clustered.bucket_count(spark, 1) == cores
        assert clustered.bucket_count(spark, 100 * clustered.LEAST_BYTES) == 100
        assert clustered.bucket_count(spark, 10**15) == 1000 == clustered.bucket_count(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_another_version_has_another_copy(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    rows = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("order_id"))
    store.load(rows, "t", "replace")
    assert clustered.clustered(store, "raw", "t", "order_id") is None
    assert clustered.cluster(store, "raw", "t", "order_id").count() == 100
    store.load(rows.where("k < 10"), "t", "append")
    assert clustered.clustered(store, "raw", "t", "order_id") is None
    again = clustered.cluster(store, "raw", "t", "order_id")
    assert again.count() == 110 and clustered.cluster(store, "raw", "t", "order_id").count() == 110
    clustered.drop(store)
    assert clustered.clustered(store, "raw", "t", "order_id") is None


def test_a_session_without_the_table_finds_the_copy(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    store.load(spark.createDataFrame([(1, None), (2, 5), (3, 5)], "k long, order_id long"), "t", "replace")
    clustered.cluster(store, "raw", "t", "order_id", 4)
    path, table = clustered._place(store, store.current_path("raw", "t"), "order_id", 4)
    spark.sql(f"DROP TABLE {table}")
    df = clustered.clustered(store, "raw", "t", "order_id", 4)
    assert df.count() == 3 and not _exchanges(df.groupBy("order_id").count())
