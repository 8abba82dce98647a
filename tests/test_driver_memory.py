"""The driver holds what is broadcast: only measured sides, in all a part of its heap."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillroll.operators import joins, keys
from tillroll.operators.joins import CONF_KEY
from tillroll.plans import checks, marts, model_tests
from tillroll.plans.model_tests import ModelTest

TESTS = (
    ModelTest("child", "a", "relationships", to=("one", "k")),
    ModelTest("child", "b", "relationships", to=("two", "k")),
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def models(spark, tmp_path):
    """Two parents of 100 keys each (5,600 bytes measured), a child with orphans and nulls."""
    ids = spark.range(120)
    frames = {
        "one": spark.range(100).select(F.col("id").alias("k")),
        "two": spark.range(100).select((F.col("id") + 10).alias("k")),
        "child": ids.select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("a"), F.col("id").alias("b")),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
    return {name: spark.read.parquet(f"{tmp_path}/{name}") for name in frames}


@pytest.fixture
def limit(spark):
    yield lambda n: spark.conf.set(CONF_KEY, str(n))
    spark.conf.unset(CONF_KEY)


def test_the_limit_is_a_part_of_the_drivers_heap(spark, limit, monkeypatch):
    df = spark.range(1)
    for heap, most in ((750 << 20, (750 << 20) // 32), (64 << 30, joins.DEFAULT_BROADCAST_BYTES)):
        monkeypatch.setattr(joins, "driver_heap", lambda df, heap=heap: heap)
        assert joins.broadcast_limit(df) == most
    limit(7)
    assert joins.broadcast_limit(df) == 7
    monkeypatch.undo()
    assert joins.driver_heap(df) > 1 << 30  # the tests' session has 8 GB


@pytest.mark.parametrize("bound, broadcast", [(12_000, 2), (10_000, 0), (0, 0)])
def test_parents_of_a_statement_share_the_limit(models, limit, bound, broadcast):
    limit(bound)
    out = model_tests.run_model_tests(models, TESTS, singular=False)
    got = {r.column_name: r.failures for r in out.collect()}
    assert got == {"a": sum(i % 7 != 0 for i in range(100, 120)), "b": 20}
    # a declined parent stays out of the driver, though its files are small to Spark
    assert _plan(out).split("Initial Plan")[0].count("BroadcastHashJoin") == broadcast


def test_declined_sides_are_merged(spark, models, limit):
    limit(0)
    child, one = models["child"].withColumnRenamed("a", "k"), models["one"]
    for how, rows in (("inner", 85), ("left", 120), ("left_anti", 35)):
        df = joins.dim_join(child, one, "k", how)
        assert df.count() == rows and "BroadcastHashJoin" not in _plan(df)
    df = checks._anti_count(child, one, "k", "n")
    assert df.collect()[0].n == 35 and "BroadcastHashJoin" not in _plan(df)


def test_payments_are_no_broadcast_lookup(spark, limit, tmp_path):
    limit(0)
    day = dt.date(2024, 1, 5)
    stg = {
        "orders": spark.createDataFrame([(1, 1, None, day), (2, 1, 5, day)], "order_id long, customer_id long, store_id long, order_date date"),
        "order_items": spark.createDataFrame([(10, 1, 1, 2), (20, 2, 1, 1), (21, 2, 9, 1)], "order_item_id long, order_id long, product_id long, quantity int")
        .withColumns({"unit_price": F.lit(3).cast("decimal(12,2)"), "discount": F.lit(0).cast("decimal(12,2)")}),
        "payments": spark.createDataFrame([(1, 2, "failed", day), (2, 2, "success", day)], "payment_id long, order_id long, payment_status string, payment_date date"),
    }
    dims = {
        "customer": spark.createDataFrame([(1, 7)], "customer_id long, customer_key long"),
        "product": spark.createDataFrame([(1, 8)], "product_id long, product_key long"),
        "store": spark.createDataFrame([(5, 9)], "store_id long, store_key long"),
        "date": spark.createDataFrame([(day, 3)], "full_date date, date_key int"),
    }
    stg["payments"].write.parquet(f"{tmp_path}/payments")
    stg["payments"] = spark.read.parquet(f"{tmp_path}/payments")
    lines = marts.fact_lines(stg, dims, dt.datetime(2024, 1, 1))
    got = sorted((r.order_item_id, r.store_key, r.payment_status) for r in lines.collect())
    assert got == [(10, None, "pending"), (20, 9, "success")]
    assert "SortMergeJoin [order_id" in _plan(lines).split("Initial Plan")[0]


@pytest.mark.parametrize("n", [2, 3, 7, 30, 500])
def test_only_the_cuts_of_the_sampled_keys_reach_the_driver(spark, monkeypatch, n):
    rows = [(i * 13 % 41 if i % 9 else None, f"k{i % 50:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(3)
    frame, got = type(df), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: got.append(collect(self)) or got[-1])
    bounds = keys.range_bounds(df, ["a", "b"], n)
    assert [len(x) for x in got] == [min(n - 1, len(got[0]))] and len(bounds) < n
    monkeypatch.undo()
    # of the sampled keys in order, those at i/n of their number
    some = df.orderBy(F.xxhash64("a", "b")).limit(keys._SAMPLED * n).orderBy("a", "b").collect()
    cuts = [some[len(some) * i // n] for i in range(1, n)]
    want = [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]
    assert [tuple(json.loads(part)[c] for part, c in zip(b, ("a", "b"))) for b in bounds] == [tuple(w) for w in want]


def test_an_empty_table_has_no_bounds(spark):
    assert keys.range_bounds(spark.createDataFrame([], "a long"), ["a"], 8) == []
