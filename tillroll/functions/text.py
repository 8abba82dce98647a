"""Text cleaning (P-1, P-2, P-3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as Python's str.strip sees it (Spark's trim() without a
# character list removes spaces only)
_SPACE = "".join(map(chr, [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def strip_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.trim(col.cast("string"), F.lit(_SPACE))


def trim_whitespace(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip leading/trailing whitespace; columns absent from ``df`` are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: strip_text(c) for c in present}) if present else df


def _title(col: Column) -> Column:
    # Title-case like Python's str.title: every run of letters starts upper-case,
    # the rest lower-case; initcap alone splits on spaces only.
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def standardize_text_case(df: DataFrame, columns: Iterable[str], case: str = "title") -> DataFrame:
    """Case-normalise text columns: ``title``, ``lower`` or ``upper``."""
    fn = {"title": _title, "lower": F.lower, "upper": F.upper}.get(case)
    if fn is None:
        return df
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: fn(F.col(c).cast("string")) for c in present}) if present else df


def normalize_emails(df: DataFrame, column: str = "email") -> DataFrame:
    """Strip and lower-case an e-mail column (no-op when absent)."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.lower(strip_text(column)))
