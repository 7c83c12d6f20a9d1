"""Column expressions over typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_MONTH = "unknown"


def day_parts(ts: Column) -> dict[str, Column]:
    """Calendar parts of the time dimension, in column order."""
    return {
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "month_name": F.date_format(ts, "MMMM"),
        "year": F.year(ts),
        "quarter": F.quarter(ts),
    }


def month_label(ts: Column) -> Column:
    """Partition value ``yyyy-MM`` of a date or timestamp."""
    return F.coalesce(F.substring(ts.cast("date").cast("string"), 1, 7), F.lit(UNKNOWN_MONTH))


def older_than(ts: Column, now: Column, days: int) -> Column:
    """True when more than ``days`` days lie between the two timestamps."""
    return now - ts > F.expr(f"interval {int(days)} days")


def whole_number(value: Column) -> Column:
    """Integer form of a numeric column."""
    return value.cast("int")


def has_value(value: Column) -> Column:
    """Neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)
