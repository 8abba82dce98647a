"""Keep-first de-duplication (P-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the first row per ``subset`` key (whole row when ``subset`` is None).

    "First" is the smallest ``order`` value; the caller supplies it (file
    position for file feeds, tie-break columns for fixtures) because a
    distributed scan has no row order. Null keys count as equal, like pandas.
    Implemented as ``min_by`` over a group-by, so duplicates collapse in the
    map-side partial aggregation: a key holding a third of all rows still sends
    one row per task through the shuffle. Order columns come from the smallest order
    itself, so they aren't carried a second time, and not at all where unused after.
    """
    if subset is None:
        return df.dropDuplicates()
    if not order:
        raise ValueError("keep-first de-duplication by key needs an order")
    keys = list(subset)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates()
    order_key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    named = {c: i for i, c in enumerate(order) if isinstance(c, str) and c in rest}
    rest = [c for c in rest if c not in named]
    low = order_key if not named else F.struct(*[F.col(c).alias(f"_{i}") for c, i in named.items()])
    aggs = [F.min_by(F.struct(*rest), order_key).alias("_first")] if rest else []
    if named:
        aggs.append(F.min_by(low, order_key).alias("_order") if len(named) < len(order) else F.min(low).alias("_order"))
    firsts = df.groupBy(*keys).agg(*aggs)
    return firsts.select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in rest], *[F.col(f"_order._{i}").alias(c) for c, i in named.items()]
    ).select(*df.columns)
