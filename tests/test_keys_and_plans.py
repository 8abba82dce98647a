"""dense_key equals the global row_number; plan shape checks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import dense_key, latest_per_group
from tillroll.operators.latest import desc_nulls_last


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_dense_key_equals_row_number(spark, parts):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("v"))
    keyed = dense_key(df, ["k", "v"], "key", num_partitions=parts)
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "v")))
    diff = keyed.join(expected, ["k", "v"]).filter(F.col("key") != F.col("rn")).count()
    assert keyed.count() == 5000 and diff == 0


def test_dense_key_has_no_single_partition_exchange(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"))
    keyed = dense_key(df, ["k"], "key", num_partitions=4)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_latest_per_group_desc_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, 10, None, "a"), (1, 11, "2024-01-02", "b"), (1, 12, "2024-01-01", "c"),
         (2, 20, None, "d"), (2, 21, None, "e")],
        "order_id int, payment_id int, payment_date string, payment_status string")
    out = {r.order_id: r.payment_status for r in latest_per_group(
        df, ["order_id"], ["payment_status"], [*desc_nulls_last("payment_date"), F.col("payment_id")]).collect()}
    assert out == {1: "b", 2: "e"}


def test_dense_key_with_offset_table(spark, tmp_path):
    import tillroll.operators.keys as K

    df = spark.range(0, 3000).select(((F.col("id") * 31) % 3001).alias("k"))
    keyed = K.dense_key(df, ["k"], "key", num_partitions=5, scratch=str(tmp_path))
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    assert keyed.join(expected, "k").filter(F.col("key") != F.col("rn")).count() == 0


def test_partitions_for_grows_with_size(spark):
    from tillroll.operators.keys import partitions_for

    df = spark.range(0, 10)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(df) == base
    assert partitions_for(df, target_bytes=8) >= base


def test_fits_broadcast_declines_big_estimates_without_a_job(spark, monkeypatch):
    import tillroll.operators.joins as J

    df = spark.range(0, 100)
    assert J.fits_broadcast(df, max_bytes=100_000) is True
    assert J.fits_broadcast(df, max_bytes=1_000) is False
    monkeypatch.setattr(J, "NO_PROOF_NEEDED_BYTES", 1)
    calls = []
    monkeypatch.setattr(J, "measured_bytes", lambda df: calls.append(1) or 0)
    assert J.fits_broadcast(spark.range(0, 101), max_bytes=2) is False and not calls


def test_dense_key_balances_a_hot_order(spark):
    # one order holds a third of all lines: range partitions on (order_id,
    # order_item_id) still split it, so no task numbers the hot order alone
    n = 30000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("order_id"),
        F.col("id").alias("order_item_id"),
    )
    keyed = dense_key(df, ["order_id", "order_item_id"], "sale_id", num_partitions=8)
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == n and max(sizes) < 2 * n / 8
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("order_id", "order_item_id")))
    assert keyed.join(expected, ["order_id", "order_item_id"]).filter(F.col("sale_id") != F.col("rn")).count() == 0


def test_dense_key_of_a_join_moves_the_rows_once(spark, tmp_path):
    """With a scratch folder the joined keys alone are stored, and the keys are the same
    for any number of partitions; the rows meet one exchange after the join."""
    left = spark.range(0, 5000).select((F.col("id") % 700).alias("a"), F.col("id").alias("b"), F.lit("x" * 50).alias("wide"))
    joined = left.join(spark.range(0, 650).select(F.col("id").alias("a"), (F.col("id") * 2).alias("c")), "a")
    expected = {(r.a, r.b): i + 1 for i, r in enumerate(joined.orderBy("a", "b").collect())}
    for n in (1, 4, 17):
        keyed = dense_key(joined, ["a", "b"], "k", n, scratch=str(tmp_path / f"s{n}"))
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1
        assert "rangepartitioning" not in plan and (n == 1 or "SinglePartition" not in plan)
        assert {(r.a, r.b): r.k for r in keyed.collect()} == expected
        assert spark.read.parquet(str(tmp_path / f"s{n}" / "keys")).columns == ["a", "b"]


@pytest.mark.parametrize("kind", ["string", "date", "decimal(12,2)"])
def test_dense_key_of_other_types_with_nulls_and_hot_values(spark, kind):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int"))
    value = {"string": F.concat(F.lit('q"\\'), F.col("id") % 300), "date": day, "decimal(12,2)": F.col("id") / 7}[kind].cast(kind)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, value).alias("k"), F.col("id").alias("v"))  # a third is null
    keyed = dense_key(df, ["k", "v"], "key", num_partitions=9)
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "v")))
    assert keyed.join(expected, "v").filter(F.col("key") != F.col("rn")).count() == 0
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 1200  # null keys are split by the second column


def test_dense_key_of_no_rows(spark):
    assert dense_key(spark.range(0).select(F.col("id").alias("k")), ["k"], "key", 4).count() == 0
