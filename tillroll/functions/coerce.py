"""Type coercion and derived columns (P-5 ... P-8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import LINE_MONEY, MONEY, WIDE_MONEY


INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}
# Text date forms accepted besides ISO (month-first as a
# general date parser reads them).
DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d")


# an ISO date, alone or with a time of day and zone; nothing else may follow
ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?\s*$"


def parse_date(c: Column | str) -> Column:
    """Text -> date: ISO forms first, then the forms above; otherwise null."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.when(text.rlike(ISO_DATE), text.try_cast(T.DateType())), *[F.try_to_date(text, fmt) for fmt in DATE_FORMATS])


def coerce_to(c: Column | str, dtype: str, source: T.DataType | None = None) -> Column:
    """Cast that turns unparsable values (and NaN) into null instead of failing.

    Integer targets accept integral text such as ``2.0`` or ``1e2`` (as a
    float parser does) and round fractional values half away from zero, as
    the database does on insert into an integer column. ``source`` is the
    input column's type when known: integral inputs take a plain cast.
    """
    col = F.col(c) if isinstance(c, str) else c
    if dtype == "string":
        return col.cast("string")
    if dtype == "date":
        return col if isinstance(source, T.DateType) else parse_date(col)
    if dtype in INTEGRAL:
        if isinstance(source, T.IntegralType):
            return col.try_cast(dtype)
        if isinstance(source, (T.FractionalType,)):
            return F.round(col, 0).try_cast(dtype)
        # text: clean integers take the direct cast; anything else is parsed
        # as a number first (only evaluated when the direct cast gave null)
        return F.coalesce(col.try_cast(dtype), F.round(col.cast("string").try_cast("decimal(38,9)"), 0).try_cast(dtype))
    return _try_cast(col, dtype)


def _try_cast(col: Column, dtype: str) -> Column:
    # NaN never reaches a decimal/integer target: try_cast of 'NaN' is null.
    return col.try_cast(dtype)


def coerce_numeric(df: DataFrame, columns: Iterable[str], dtype: str = MONEY) -> DataFrame:
    """To numeric; bad values become null (absent columns ignored)."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: _try_cast(F.col(c), dtype) for c in present}) if present else df


def coerce_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """To date; bad values become null (absent columns ignored)."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_date(c) for c in present}) if present else df


def line_total(quantity: Column | str, unit_price: Column | str, discount: Column | str | None, dtype: str = LINE_MONEY) -> Column:
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(unit_price) if isinstance(unit_price, str) else unit_price
    d = F.lit(0) if discount is None else (F.col(discount) if isinstance(discount, str) else discount)
    return (q * p - d).cast(dtype)


def add_line_total(
    df: DataFrame,
    quantity_col: str = "quantity",
    unit_price_col: str = "unit_price",
    discount_col: str = "discount",
    output_col: str = "line_total",
) -> DataFrame:
    """quantity * unit_price - discount; a missing discount column counts as 0 (P-7).
    The result type holds every value of the inputs (models use a narrower one,
    behind a rule at ingest)."""
    disc = discount_col if discount_col in df.columns else None
    return df.withColumn(output_col, line_total(quantity_col, unit_price_col, disc, WIDE_MONEY))
