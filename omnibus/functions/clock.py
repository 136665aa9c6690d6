"""Times of day, wall-clock parts of offset strings, instants."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from omnibus import params

_TIME_OF_DAY = r"^\d{1,3}:[0-5]\d:[0-5]\d$"


def gtfs_seconds(time_of_day: Column) -> Column:
    """Seconds since the start of the service day; hours may pass 24.

    Text that is not H:MM:SS gives NULL.
    """
    text = F.trim(time_of_day)
    part = F.split(text, ":")
    hours, minutes, seconds = (part[i].try_cast("int") for i in range(3))
    return F.when(text.rlike(_TIME_OF_DAY), hours * 3600 + minutes * 60 + seconds)


def service_hour(seconds: Column, wrap_hours: bool = False) -> Column:
    """Hour of the service day, 24 and more after midnight unless wrapped."""
    hour = F.floor(seconds / 3600).cast("int")
    return hour % 24 if wrap_hours else hour


def peak_flag(hour: Column, bands=params.PEAK_HOURS) -> Column:
    """1 inside a peak band, else 0 (NULL hours are off-peak)."""
    inside = reduce(lambda a, b: a | b, [hour.between(lo, hi) for lo, hi in bands])
    return F.when(inside, 1).otherwise(0)


def time_slot(hour: Column) -> Column:
    (lo, hi, label), *rest = params.TIME_SLOTS
    slot = F.when(hour.between(lo, hi), label)
    for lo, hi, label in rest:
        slot = slot.when(hour.between(lo, hi), label)
    return slot.otherwise(params.EARLY_SLOT)


def instant(iso_text: Column) -> Column:
    """Exact instant of an ISO string with offset, NULL if it does not parse."""
    return F.try_to_timestamp(iso_text)


def wall_date(iso_text: Column, strict: bool = True) -> Column:
    """Local date of an ISO string; strict raises on junk, else NULL."""
    text = F.substring(iso_text, 1, 10)
    return text.cast("date") if strict else text.try_cast("date")


def wall_hour(iso_text: Column, strict: bool = True) -> Column:
    """Local hour of an ISO string; strict raises on junk, else NULL."""
    text = F.substring(iso_text, 12, 2)
    return text.cast("int") if strict else text.try_cast("int")


def ingest_second(ingested_at: Column) -> Column:
    """Ingestion time at second grain, without its offset; NULL if junk."""
    return F.left(ingested_at, F.lit(19)).try_cast("timestamp_ntz")


def utc(moment: dt.datetime) -> Column:
    """A literal instant; a moment without a zone is UTC, whatever the process or session zone."""
    zoned = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    since = zoned - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(since // dt.timedelta(microseconds=1)))


def wall(moment: dt.datetime) -> Column:
    """A literal wall-clock time without a zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(as_of: dt.datetime, days: int) -> Column:
    return utc(as_of) - F.make_dt_interval(days=F.lit(days))


def local_display(utc: Column, zone: str = params.DISPLAY_ZONE) -> Column:
    """Short local date and time of a UTC timestamp, for screens."""
    return F.date_format(F.from_utc_timestamp(utc, zone), "d MMM, HH:mm")
