"""Calendar arithmetic on zone-less timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(moment: dt.datetime) -> Column:
    """A zone-less literal; the zone of neither Python nor the session matters."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end; hours of the day do not matter."""
    return F.datediff(end, start)


def months_between(start: Column, end: Column) -> Column:
    """Month boundaries crossed from start to end (Jan 31 to Feb 1 is one)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def month_start(ts: Column) -> Column:
    """First instant of the month, without passing through a time zone."""
    return F.trunc(ts, "month").cast("timestamp_ntz")


def month_label(ts: Column) -> Column:
    """'YYYY-MM'."""
    return F.date_format(ts, "yyyy-MM")


def parse_timestamp(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' or another ISO form, null when it is neither.

    Read without a zone from the start, so the zone of the session never shifts a value.
    """
    return text.try_cast("timestamp_ntz")
