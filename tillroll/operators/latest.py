"""Latest row per group (W-3, L-4) as an aggregate, not a sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_group(
    df: DataFrame,
    group: Sequence[str],
    values: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """One row per ``group`` carrying ``values`` of the row with the largest ``order``.

    ``DISTINCT ON (g) ... ORDER BY g, a DESC NULLS LAST, b DESC`` becomes
    ``max_by(values, struct(a IS NOT NULL, a, b))``: partial aggregation
    collapses each group map-side, so a hot group never lands whole in one task.
    """
    pick = F.max_by(F.struct(*values), F.struct(*order)).alias("_latest")
    return df.groupBy(*group).agg(pick).select(*group, *[F.col(f"_latest.{v}").alias(v) for v in values])


def desc_nulls_last(c: str) -> list[Column]:
    """Ordering key parts equivalent to ``c DESC NULLS LAST`` under max_by."""
    return [F.col(c).isNotNull(), F.col(c)]
