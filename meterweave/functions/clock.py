"""Time arithmetic on TIMESTAMP_NTZ columns; nothing here looks at the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MINUTE = 60_000_000
DAY = 1_440 * MINUTE


def intervals_per_day(interval_minutes: int) -> int:
    return int(1440 / interval_minutes)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of the naive timestamp."""
    return minutes(ts) * MINUTE + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def minutes(ts: Column) -> Column:
    """Whole minutes since 1970-01-01 00:00; exact for differences along one grid."""
    return F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def plus_micros(ts: Column, amount: Column) -> Column:
    return F.timestamp_add("MICROSECOND", amount, ts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def hhmm(minute: Column) -> Column:
    return F.format_string("%02d:%02d", (minute / 60).cast("int"), (minute % 60).cast("int"))


def in_hours(ts_hour: Column, bounds: tuple[int, int]) -> Column:
    return (ts_hour >= bounds[0]) & (ts_hour < bounds[1])
