"""Time helpers that treat TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F


def interval(length: timedelta) -> Column:
    return F.lit(length)


def slice_index(ts: Column, hours: int) -> Column:
    """Number of the ``hours``-wide slice of the time line that holds ``ts``.

    Built from the calendar date and the hour, so it never decreases as ``ts``
    grows, for zoned and zoneless timestamps alike.
    """
    hour_number = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)
    return F.floor(hour_number / F.lit(hours)).cast("int")


def whole_seconds_between(later: Column, earlier: Column) -> Column:
    """Difference of the two times, each floored to a whole second."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def trailing_window_start(as_of: str, days: int) -> Column:
    """First instant of a trailing window of ``days`` that ends at ``as_of``."""
    return F.date_sub(F.to_date(F.lit(as_of)), days)
