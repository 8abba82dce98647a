"""Product catalog overlay (S-3) with snapshot fallback (S-4)."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import PRODUCTS
from tillroll.sources.fixtures import SEQ


log = logging.getLogger(__name__)


def overlay_products(snapshot: DataFrame, extract: DataFrame) -> DataFrame:
    """Snapshot rows overlaid by the API extract: per product_id the last row
    of (snapshot in file order, then extract in order) wins.

    The extract's ``id``/``title`` become ``product_id``/``product_name``; both
    sides are cut to the required columns, as in the reference, so category
    and store_id do not survive this path. The winner is picked with
    ``max_by`` on (source rank, position): an aggregate, so a repeated id
    collapses map-side.
    """
    req = PRODUCTS.required_columns
    api = extract.withColumnRenamed("id", "product_id").withColumnRenamed("title", "product_name")
    if snapshot.schema[SEQ].dataType.simpleString() != api.schema[SEQ].dataType.simpleString():
        raise ValueError("both feeds need positions of one type")
    snap = snapshot.select(*req, F.struct(F.lit(0).alias("src"), F.col(SEQ).alias("pos")).alias(SEQ))
    api = api.select(*req, F.struct(F.lit(1).alias("src"), F.col(SEQ).alias("pos")).alias(SEQ))
    rest = [c for c in req if c != "product_id"]
    last = snap.unionByName(api).groupBy("product_id").agg(
        F.max_by(F.struct(*rest, F.col(SEQ)), F.col(SEQ)).alias("_w")
    )
    return last.select("product_id", *[F.col(f"_w.{c}").alias(c) for c in rest], F.col(f"_w.{SEQ}").alias(SEQ))


def products_input(
    snapshot: Callable[[], DataFrame],
    extract: Callable[[], DataFrame] | None,
) -> tuple[DataFrame, str]:
    """(products feed, source label): overlay when the extract reads, else the snapshot."""
    ext = None
    if extract is not None:
        try:
            ext = extract()
            ext.schema  # resolves the plan: fails here if the landed extract is unreadable
        except (OSError, RuntimeError, ValueError, PySparkException) as exc:
            log.warning("products extract can't be read, using the snapshot alone: %s", exc)
            ext = None
    if ext is None:
        return snapshot(), "csv:products.csv"
    return overlay_products(snapshot(), ext), "api:products+csv:snapshot"
