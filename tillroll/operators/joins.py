"""Joins with a checked broadcast side."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured size is at most this many bytes
# (after projecting it to the columns the join needs),
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
# and at most this part of the driver's heap. The driver collects the rows, hashes them
# into a table that grows by doubling, and keeps that table and its blocks: some three
# times the size, for each of several dimensions of a plan.
DRIVER_PART = 32
CONF_KEY = "tillroll.broadcast.maxBytes"
# Above this estimate (compressed files) the answer is "no" without a job:
# declining to broadcast is always safe, only "yes" needs the proof.
NO_PROOF_NEEDED_BYTES = 1024 * 1024 * 1024
# what Catalyst says of a source whose size it doesn't know
_NO_ESTIMATE = 1 << 60
# what a row takes besides its values
_ROW_BYTES = 48


def broadcast_limit(df: DataFrame) -> int:
    """Bytes of a side that may be broadcast: as the session says, else what the
    driver can hold."""
    v = df.sparkSession.conf.get(CONF_KEY, None)
    return int(v) if v else min(DEFAULT_BROADCAST_BYTES, driver_heap(df) // DRIVER_PART)


def driver_heap(df: DataFrame) -> int:
    """Bytes that the driver's heap can grow to."""
    return int(df.sparkSession.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory())


@lru_cache(maxsize=512)
def _known(key: tuple) -> list:
    """One mutable slot per (plan, estimate, limit); the oldest are forgotten."""
    return []


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (file sizes for scans; no job)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001 - no estimate available
        return None
    return int(size) if isinstance(size, int) else int(str(size.toString()))


def input_bytes(df: DataFrame) -> int | None:
    """Bytes the plan reads: the sum of its leaf estimates (file sizes for
    scans). Unlike the root estimate it is not inflated by joins."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        total = 0
        for i in range(leaves.size()):
            size = leaves.apply(i).stats().sizeInBytes()
            total += int(size) if isinstance(size, int) else int(str(size.toString()))
        return total
    except Exception:  # noqa: BLE001 - no estimate available
        return None


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df`` in memory: a fixed part per row and the lengths
    of its strings. One aggregation, combined before the shuffle."""
    width = F.lit(_ROW_BYTES + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
    return int(df.agg(F.sum(width)).first()[0] or 0)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True iff the rows of ``df`` take at most ``max_bytes``, proven by measuring
    them; plans estimated far above that are declined without a job.

    The answer is kept per (canonical plan, estimate): committed table versions are
    immutable, and another version has another path and so another plan.
    """
    bound = broadcast_limit(df) if max_bytes is None else max_bytes
    est = estimated_bytes(df)
    if est is not None and max(NO_PROOF_NEEDED_BYTES, bound) < est < _NO_ESTIMATE:
        return False
    slot = _known((id(df.sparkSession), df.semanticHash(), est, bound))
    if not slot:
        slot.append(measured_bytes(df) <= bound)
    return slot[0]


def sized(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``df`` as a side of a join: broadcast when proven small, else to be merged.

    Without that hint Spark may broadcast a side that was declined: it goes by the
    bytes of the compressed files, and dense ids take a hundredth there of what they
    take in the driver."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df.hint("merge")


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on,
    how: str = "inner",
    max_bytes: int | None = None,
) -> DataFrame:
    """Join ``fact`` to ``dim``: broadcast-hash when ``dim`` is proven small,
    else a shuffle join (AQE splits skewed partitions)."""
    return fact.join(sized(dim, max_bytes), on, how)
