"""Date/time Column helpers.  Session time zone is UTC (see ``session.prepare``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import TS_TEXT_FORMAT
from .numeric import col_of


def parse_ts(c: str | Column) -> Column:
    """Text -> timestamp, unparsable -> null (ANSI-safe)."""
    return F.try_to_timestamp(col_of(c))


def ts_text(c: str | Column) -> Column:
    """Timestamp -> 'yyyy-MM-dd HH:mm:ss' (fraction truncated)."""
    return F.date_format(col_of(c), TS_TEXT_FORMAT)


def minutes_whole_seconds(start: str | Column, end: str | Column) -> Column:
    """Duration in minutes from whole epoch seconds of both ends (stream rule)."""
    return (F.unix_timestamp(col_of(end)) - F.unix_timestamp(col_of(start))) / F.lit(60.0)


def minutes_fractional(start: str | Column, end: str | Column) -> Column:
    """Duration in minutes keeping sub-second precision (training rule)."""
    return (F.unix_micros(col_of(end)) - F.unix_micros(col_of(start))) / F.lit(60_000_000.0)


def speed_mph(distance: str | Column, minutes: str | Column) -> Column:
    """distance / hours; zero hours -> null."""
    hours = col_of(minutes) / F.lit(60.0)
    return F.try_divide(col_of(distance), F.nullif(hours, F.lit(0.0)))


def weekday_mon0(c: str | Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(col_of(c))


def is_weekend(dow: str | Column) -> Column:
    return (col_of(dow) >= 5).cast("int")


def add_minutes(c: str | Column, minutes: int) -> Column:
    return col_of(c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))


def add_days(c: str | Column, days: int | Column) -> Column:
    d = days if isinstance(days, Column) else F.lit(days)
    return col_of(c) + F.make_dt_interval(d)
