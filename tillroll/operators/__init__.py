"""Operators Spark lacks as one call, built from DataFrame primitives."""

from tillroll.operators.dedup import drop_exact_duplicates
from tillroll.operators.joins import dim_join, fits_broadcast
from tillroll.operators.keys import dense_key
from tillroll.operators.latest import latest_per_group

__all__ = ["dense_key", "dim_join", "drop_exact_duplicates", "fits_broadcast", "latest_per_group"]
