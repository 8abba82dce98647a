"""The registered schemas answer questions of our own in plain SQL."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.plans.catalog import register_catalog
from tillroll.plans.warehouse import open_warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    out = open_warehouse(spark, SF)
    out.names = register_catalog(spark, out)
    return out


def test_every_name_can_be_queried(spark, wh):
    assert {"raw.orders", "staging.stg_orders", "staging.int_customer_orders", "warehouse.fact_sales", "audit.pipeline_runs",
            "audit.model_test_results", "audit.rejected_records", "audit.data_quality_results"} <= set(wh.names)
    for name in wh.names:
        assert spark.table(name).columns


def test_each_dimension_explains_every_line_it_should(spark, wh):
    for dim, key, optional in [("customer", "customer_key", False), ("product", "product_key", False), ("store", "store_key", True), ("date", "date_key", False)]:
        found = spark.sql(f"select count(*) all_lines, count(d.{key}) explained, count(f.{key}) keyed from warehouse.fact_sales f left join warehouse.dim_{dim} d using ({key})").first()
        assert found.explained == found.keyed
        assert found.keyed == found.all_lines or optional


def test_lines_without_a_store_keep_their_money(spark, wh):
    by_store = spark.sql("select store_key is null lacking, sum(total_amount) money from warehouse.fact_sales group by all")
    money = {r.lacking: r.money for r in by_store.collect()}
    assert money[True] > 0 and sum(money.values(), Decimal(0)) == wh.fact.agg(F.sum("total_amount")).first()[0]


def test_rejects_and_bronze_rows_make_up_the_feed(spark, wh):
    rejected = {r.table_name: r.n for r in spark.sql("select table_name, count(*) n from audit.rejected_records group by 1").collect()}
    for t in ("orders", "customers", "payments"):
        distinct = wh.feed(t).select({"orders": "order_id", "customers": "customer_id", "payments": "payment_id"}[t]).distinct().count()
        assert spark.table(f"raw.{t}").count() + rejected.get(t, 0) == distinct


def test_staging_views_equal_the_staging_frames(spark, wh):
    for name, frame in wh.stg().items():
        view = spark.table(f"staging.stg_{name}")
        assert view.columns == frame.columns and view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty()


def test_last_run_can_be_read(spark, wh):
    last = spark.sql("select status, records_processed from audit.pipeline_runs order by run_id desc limit 1").first()
    assert last.status in ("success", "failed") and last.records_processed > 0
    failed = spark.sql("select count(*) from audit.model_test_results where status = 'fail'").first()[0]
    assert (failed > 0) == (last.status == "failed") == (wh.status == "failed")
