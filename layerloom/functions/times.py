"""Dates, clock times and zone offsets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_time(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    """Timestamp from a date and an ``HHMM`` text; an impossible time such as 24:00 gives null."""
    hour = F.substring(hhmm, 1, 2).cast("int")
    minute = F.substring(hhmm, 3, 2).cast("int")
    return F.try_make_timestamp_ntz(
        year.cast("int"), month.cast("int"), day.cast("int"), hour, minute, F.lit(0)
    )


def minutes(count: Column) -> Column:
    """A signed number of minutes as an interval; null stays null."""
    return F.make_dt_interval(F.lit(0), F.lit(0), count.cast("int"), F.lit(0))


def zone_offset_minutes(zone: Column, as_of: Column) -> Column:
    """Offset of a named zone from UTC, in minutes, at the instant ``as_of``."""
    return F.timestamp_diff("MINUTE", as_of, F.from_utc_timestamp(as_of, zone))


def date_literal(value: dt.date | None) -> Column:
    """The given date, or the current date of the session."""
    return F.current_date() if value is None else F.lit(value).cast("date")
