"""Run dates, partition names and epoch stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the start-of-time stamp that sorts an opening balance before any event.
START_OF_TIME = "0001-01-01 00:00:00"


def as_date(ds: dt.date | str) -> dt.date:
    return ds if isinstance(ds, dt.date) else dt.date.fromisoformat(ds)


def parse_stamp(text: Column) -> Column:
    """``'2024-01-15 09:30:00'`` as a time stamp; NULL for anything else."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def partition_label(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def epoch_date(seconds: Column) -> Column:
    """The UTC day of an epoch stamp, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(86_400)).cast("int"))


def epoch_millis_date(millis: Column) -> Column:
    return epoch_date(F.floor(millis / F.lit(1000)))


def start_of_time() -> Column:
    return F.lit(START_OF_TIME).cast("timestamp_ntz")


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def time_slot(stamp: Column, unit: str = "hour") -> Column:
    """Number of the hour, minute or second a stamp falls into, the same in every session zone."""
    hours = F.unix_date(F.to_date(stamp)).cast("bigint") * 24 + F.hour(stamp)
    if unit == "hour":
        return hours
    minutes = hours * 60 + F.minute(stamp)
    return minutes if unit == "minute" else minutes * 60 + F.second(stamp)
