"""Instants as wall-clock time of a zone, whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(instant: Column, zone: Column) -> Column:
    """A TIMESTAMP as zone-less local time in ``zone``."""
    return F.convert_timezone(F.current_timezone(), zone, instant.cast("timestamp_ntz"))


def local_date(instant: Column, zone: Column) -> Column:
    return F.to_date(wall_clock(instant, zone))


def at_clock(day: Column, hh_mm: Column) -> Column:
    """Zone-less time ``HH:MM`` on a date."""
    return F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(" "), hh_mm), F.lit("yyyy-MM-dd H:mm"))


def quarter_hour(instant: Column) -> Column:
    """A quarter-hour number. Day borders of every zone fall between two of them."""
    return F.floor(F.unix_seconds(instant) / 900)
