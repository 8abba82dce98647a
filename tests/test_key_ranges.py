"""The range of a key is found by compiled columns."""

import bisect
import json

import pytest
from pyspark.sql import functions as F

from tillroll.operators import dense_key
from tillroll.operators.keys import range_bounds, with_range


@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_range_is_the_number_of_bounds_at_or_below(spark, n):
    rows = [(i % 37, f"k{i * 7 % 90:02d}") for i in range(300)] + [(None, "a"), (None, None), (3, None)]
    df = spark.createDataFrame(rows, "a long, b string")
    bounds = range_bounds(df, ["a", "b"], n)
    out = with_range(df, ["a", "b"], bounds, "_range").collect()
    assert len(out) == len(rows)

    def key(a, b):
        return (a is not None, a or 0, b is not None, b or "")

    def of(text):
        row = json.loads("{" + ", ".join(p[1:-1] for p in text) + "}")
        return key(row["a"], row["b"])

    cuts = [of(b) for b in bounds]
    assert all(r["_range"] == bisect.bisect_right(cuts, key(r.a, r.b)) for r in out)


def test_key_ranges_are_searched_by_compiled_columns(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"))
    keyed = dense_key(df, ["k"], "n", num_partitions=16)
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    # a lambda is interpreted for each row and each halving
    assert "lambda" not in plan
    assert all(r.n == r.k + 1 for r in keyed.collect())
