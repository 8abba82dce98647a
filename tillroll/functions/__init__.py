"""Column-level functions (all JVM-side built-ins, no Python UDFs)."""

from tillroll.functions.calendar import calendar_attributes, date_key, month_start
from tillroll.functions.coerce import (
    add_line_total,
    coerce_dates,
    coerce_numeric,
    coerce_to,
    line_total,
)
from tillroll.functions.text import normalize_emails, standardize_text_case, strip_text, trim_whitespace

__all__ = [
    "add_line_total",
    "calendar_attributes",
    "coerce_dates",
    "coerce_numeric",
    "coerce_to",
    "date_key",
    "line_total",
    "month_start",
    "normalize_emails",
    "standardize_text_case",
    "strip_text",
    "trim_whitespace",
]
