"""Timestamp parsing, calendar parts and durations.

All functions take ``timestamp`` and ``timestamp_ntz`` alike. Session time zone UTC is assumed for
zoned timestamps, as in every other lake job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Weekday names, first day Sunday, as numbered by ``dayofweek``.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def parse_timestamps(df: DataFrame, *names: str) -> DataFrame:
    """Turn text columns into timestamps (malformed text gives null); others stay as they are."""
    text = {n: F.try_to_timestamp(n) for n in names if isinstance(df.schema[n].dataType, StringType)}
    return df.withColumns(text) if text else df


def calendar_parts(ts: Column | str, **names: str) -> dict[str, Column]:
    """Map output names to calendar parts: ``calendar_parts("ts", date="d", hour="h")``."""
    parts = {
        "date": F.to_date,
        "hour": F.hour,
        "week": F.weekofyear,
        "month": F.month,
        "year": F.year,
        "weekday": F.dayofweek,
        "weekday_name": day_name,
        "weekday_short": day_short_name,
    }
    ts = F.col(ts) if isinstance(ts, str) else ts
    return {name: parts[part](ts) for part, name in names.items()}


def _weekday_lookup(ts: Column, names: list[str]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), F.dayofweek(ts) - 1)


def day_name(ts: Column) -> Column:
    """Full weekday name; a missing timestamp reads as Saturday, the last of the list."""
    return F.coalesce(_weekday_lookup(ts, list(DAY_NAMES)), F.lit(DAY_NAMES[-1]))


def day_short_name(ts: Column) -> Column:
    """Three-letter weekday name, null for a missing timestamp."""
    return _weekday_lookup(ts, [n[:3] for n in DAY_NAMES])


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end; each side is cut to its second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(60)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end."""
    return F.datediff(end, start)
