"""Dense surrogate keys without a single-partition window (W-1, W-2).

``row_number() over (order by k)`` with no partition runs in one task. Here only the
order columns are looked at before the rows move:

1. of the distinct keys those with the smallest hashes, a uniform sample, give range
   bounds;
2. a histogram of the keys over these ranges gives the number of rows before each;
3. the rows move once, to the partition of their range, are sorted there, and get
   rows before the range + position in the partition. The position comes from
   ``monotonically_increasing_id`` (record number in the low 33 bits) after the sort, so
   numbering is a narrow projection and the result is written where the caller wants
   it, once.

Equals the global row_number when the order columns are unique.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.joins import input_bytes

_LOW_BITS = (1 << 33) - 1
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: sampled keys a range (ranges then differ by about a tenth of their size), and in all
_SAMPLED, _MOST_SAMPLED = 100, 200_000


def partitions_for(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Range partitions for ``df``: at least ``spark.sql.shuffle.partitions``,
    more when the bytes the plan reads (sum of its scans' sizes) would make
    partitions exceed ``target_bytes`` (the estimate only sizes the work, it
    never changes the result)."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    est = input_bytes(df)
    if est is None:
        return base
    return max(base, -(-est // target_bytes))


def dense_key(
    df: DataFrame,
    order_cols: Sequence[str],
    out: str,
    num_partitions: int | None = None,
    first: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order_cols`` order (nulls first).

    The order columns are read on their own before, so ``df`` must give the same rows
    each time. ``scratch`` is a shared folder of the caller's, who deletes it once the
    result has been stored: keys that a join makes are stored there, to make them once.
    ``first=True`` puts the key as the first column.
    """
    order = list(order_cols)
    cols = [c for c in df.columns if c != out]
    keys = df.select(*order)
    if scratch is not None and _joins(keys):
        keys = _stored(keys, f"{scratch}/keys")
    n = num_partitions or partitions_for(df)
    bounds = range_bounds(keys, order, n)
    # one row per range: bounded by the partition count, not the data
    counts = {r["_range"]: r["count"] for r in with_range(keys, order, bounds, "_range").groupBy("_range").count().collect()}
    before, offsets = 0, []
    for p in range(len(bounds) + 1):
        offsets.append(before)
        before += counts.get(p, 0)
    ranged = with_range(df, order, bounds, "_range").repartitionById(len(offsets), F.col("_range")).sortWithinPartitions(*order)
    start = F.element_at(_literal(offsets, T.ArrayType(T.LongType())), F.col("_range") + 1)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))
    numbered = ranged.select((start + position + 1).alias(out), *cols)
    return numbered if first else numbered.select(*cols, out)


def range_bounds(keys: DataFrame, order: Sequence[str], n: int) -> list[list]:
    """At most n - 1 ascending keys that cut ``keys`` into ranges of about equal size."""
    if n < 2:
        return []
    some = keys.orderBy(F.xxhash64(*order)).limit(min(_SAMPLED * n, _MOST_SAMPLED))
    # one task sorts the sampled keys; the driver gets only those that cut them
    sample = some.agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_s"))
    placed = sample.select(F.size("_s").cast("long").alias("_m"), F.posexplode("_s").alias("_i", "_k"))
    nth = F.greatest(F.lit(1), F.expr(f"(_i * {n}L + _m - 1) div _m"))
    kept = placed.where((nth < n) & (F.col("_i") == F.floor(F.col("_m") * nth / n)))
    rows = kept.select("_i", *[F.to_json(F.struct(F.col("_k")[c].alias(c)), {"ignoreNullFields": "false"}) for c in order]).collect()
    cuts = [list(r)[1:] for r in sorted(rows, key=lambda r: r[0])]
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def with_range(df: DataFrame, order: Sequence[str], bounds: list[list], out: str) -> DataFrame:
    """Add ``out``: how many bounds lie at or below a row's key, by binary search. Each
    halving is a column of its own, so that it is compiled and evaluated once a row."""
    cols = df.columns
    if not bounds:
        return df.withColumn(out, F.lit(0))
    key = F.struct(*order)
    kind = T.StructType([df.schema[c] for c in order])
    values = [json.loads("{" + ", ".join(part[1:-1] for part in b) + "}") for b in bounds]
    table = _literal(values, T.ArrayType(kind))
    found = df.withColumn(out, F.lit(0))
    for i in reversed(range(len(bounds).bit_length())):
        ahead = F.col(out) + (1 << i)
        # the element is looked up within the table even where the answer is no
        below = (ahead <= len(bounds)) & (F.element_at(table, F.least(ahead, F.lit(len(bounds)))) <= key)
        found = found.select(*cols, F.when(below, ahead).otherwise(F.col(out)).alias(out))
    return found


def _literal(values: list, kind: T.DataType) -> Column:
    """A constant of any size as one expression."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _joins(df: DataFrame) -> bool:
    return "Join" in df._jdf.queryExecution().optimizedPlan().toString()


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
