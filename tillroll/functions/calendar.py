"""Calendar expressions (F-4 ... F-10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def aware(ts: dt.datetime) -> dt.datetime:
    """``ts`` in UTC; one without a zone is taken as UTC, never as local time."""
    return ts.replace(tzinfo=dt.timezone.utc) if ts.tzinfo is None else ts.astimezone(dt.timezone.utc)


def utc(ts: dt.datetime) -> Column:
    """A timestamp literal that doesn't depend on the driver's time zone."""
    return F.lit(aware(ts)).cast("timestamp")


def date_key(d: Column) -> Column:
    """YYYYMMDD as an int (to_char(d, 'YYYYMMDD')::int)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(d: Column) -> Column:
    """date_trunc('month', d)::date."""
    return F.trunc(d, "month")


def calendar_attributes(d: Column, pad_names: bool = False) -> dict[str, Column]:
    """Attributes of dim_date for a date column. ``day_of_week``: 0 = Monday.

    PostgreSQL's to_char 'Month'/'Day' blank-pads names to 9 characters;
    ``pad_names=True`` reproduces that, the default leaves names unpadded.
    """
    month_name = F.date_format(d, "MMMM")
    day_name = F.date_format(d, "EEEE")
    if pad_names:
        month_name = F.rpad(month_name, 9, " ")
        day_name = F.rpad(day_name, 9, " ")
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": month_name,
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_name": day_name,
        "is_weekend": F.weekday(d) >= 5,
    }
