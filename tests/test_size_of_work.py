"""What a task sorts or groups is bounded, and its rows carry nothing twice."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import drop_exact_duplicates
from tillroll.session import tune

SPLITS = "spark.sql.files.maxPartitionBytes"
COALESCED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_keep_first_carries_its_order_once(spark):
    rows = [(i % 5, i, f"v{i}") for i in range(40)] + [(None, 3, "n3"), (None, 1, "n1")]
    df = spark.createDataFrame(rows, "k long, pos long, v string")
    out = drop_exact_duplicates(df, ["k"], order=[F.struct("pos").alias("p"), "pos"])
    assert sorted((str(r.k), r.pos, r.v) for r in out.collect()) == sorted(
        [(str(i), i, f"v{i}") for i in range(5)] + [("None", 1, "n1")])
    unused = drop_exact_duplicates(df, ["k"], order=["pos"]).select("k", "v")
    plan = unused._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by(struct(v, v#" in plan and "min(" not in plan
    assert {r.k: r.v for r in unused.collect()} == {None: "n1", **{i: f"v{i}" for i in range(5)}}


@pytest.mark.parametrize("size", [SPLITS, COALESCED])
def test_tasks_read_what_they_can_sort(spark, size):
    before = spark.conf.get(size, None)
    try:
        spark.conf.unset(size)
        tune(spark)
        assert spark.conf.get(size) == str(16 << 20)
        spark.conf.set(size, "3m")  # given by the user
        tune(spark)
        assert spark.conf.get(size) == "3m"
    finally:
        spark.conf.set(size, before) if before is not None else spark.conf.unset(size)
