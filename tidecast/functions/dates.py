"""Calendar arithmetic. Weekdays run Monday = 0 to Sunday = 6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/New_York"


def weekday(day: Column) -> Column:
    return F.weekday(day)


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def days_to_sunday(day: Column) -> Column:
    """Days to the coming Sunday; a Sunday looks a full week ahead."""
    return F.date_diff(F.next_day(day, "SU"), day)


def week_start(day: Column) -> Column:
    """Monday of the day's week."""
    return F.date_trunc("week", day).cast("date")


def local_time(ts: Column, zone: str = LOCAL_ZONE, source_zone: str | None = "UTC") -> Column:
    """Wall-clock time in ``zone``. ``source_zone=None`` reads a true instant."""
    source = F.lit(source_zone) if source_zone else None
    return F.convert_timezone(source, F.lit(zone), ts.cast("timestamp_ntz"))


def local_date(ts: Column, zone: str = LOCAL_ZONE, source_zone: str | None = "UTC") -> Column:
    return local_time(ts, zone, source_zone).cast("date")


def tomorrow(as_of: Column) -> Column:
    return F.date_add(as_of, 1)
