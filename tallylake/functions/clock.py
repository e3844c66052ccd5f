"""Instants, days and time texts that do not depend on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z.
MIN_SECOND, MAX_SECOND = -62135596800, 253402300799

_OFFSET = r"[T ][0-9:.,]+\s*(?:Z|[+-]\d{2}(?::?\d{2}){0,2})$"


def utc_clock(instant: Column) -> Column:
    """The UTC wall clock of a TIMESTAMP, as TIMESTAMP_NTZ."""
    return _epoch_clock(F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)"))


def utc_clock_of_seconds(seconds: Column) -> Column:
    return _epoch_clock(seconds)


def _epoch_clock(seconds: Column) -> Column:
    zero = F.lit(0)
    step = F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + step


def utc_day(instant: Column) -> Column:
    """The UTC calendar day of a TIMESTAMP."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def business_day(df: DataFrame, column: str, zone: str = "UTC") -> Column:
    """The calendar day in the business zone. A TIMESTAMP_NTZ is taken as UTC."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        value = utc_clock(value)
    if zone != "UTC":
        value = F.convert_timezone(F.lit("UTC"), F.lit(zone), value)
    return F.to_date(value)


def iso_utc(clock: Column) -> Column:
    """``2026-09-25T14:48:21Z``; microseconds in six digits only when there are any."""
    text = clock.cast("string")
    seconds = F.replace(F.substring_index(text, ".", 1), F.lit(" "), F.lit("T"))
    fraction = F.when(
        F.contains(text, F.lit(".")),
        F.concat(F.lit("."), F.rpad(F.substring_index(text, ".", -1), 6, "0")),
    ).otherwise(F.lit(""))
    return F.concat(seconds, fraction, F.lit("Z"))


def iso_utc_of_seconds(seconds: Column) -> Column:
    """Epoch seconds as text; NULL outside the years 1 to 9999."""
    inside = seconds.between(MIN_SECOND, MAX_SECOND)
    return F.when(inside, iso_utc(utc_clock_of_seconds(seconds)))


def has_offset(text: Column) -> Column:
    """Whether an ISO date-time text names its offset."""
    return text.rlike(_OFFSET)
