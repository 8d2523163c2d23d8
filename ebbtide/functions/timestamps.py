"""Epoch-millisecond timestamps, UTC days and bucket widths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 0001-01-01 to 9999-12-31: anything outside is not a usable log time.
MIN_EPOCH_MS = -62_135_596_800_000
MAX_EPOCH_MS = 253_402_300_799_999

# Selectable bucket widths.
INTERVALS = {
    "5m": "5 minutes",
    "10m": "10 minutes",
    "30m": "30 minutes",
    "1h": "1 hour",
    "6h": "6 hours",
    "12h": "12 hours",
    "1d": "1 day",
    "7d": "7 days",
    "14d": "14 days",
    "30d": "30 days",
}


def timestamp_from_ms(ms: Column) -> Column:
    """Timestamp of epoch milliseconds; NULL for NULL, NaN and out-of-range values."""
    usable = F.when(ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS), ms)
    return F.timestamp_micros(F.rint(usable * 1000).cast("bigint"))


def utc_day(timestamp: Column) -> Column:
    """UTC day of a timestamp, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(timestamp) / 86400).cast("int"))


def with_timestamps(df: DataFrame) -> DataFrame:
    """Add ``timestamp``, ``registration_timestamp`` and the ``date`` key."""
    return df.withColumns(
        {
            "timestamp": timestamp_from_ms(F.col("ts")),
            "registration_timestamp": timestamp_from_ms(F.col("registration")),
        }
    ).withColumn("date", utc_day(F.col("timestamp")))


def time_bucket(timestamp: Column, interval: str) -> Column:
    """Start of the epoch-aligned bucket that holds ``timestamp``."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {list(INTERVALS)}, not {interval!r}")
    return F.window(timestamp, INTERVALS[interval])["start"]


def as_utc(value: str | dt.date | dt.datetime) -> dt.datetime:
    """A moment in UTC; naive values and plain dates are taken as UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return value.replace(tzinfo=dt.UTC) if value.tzinfo is None else value.astimezone(dt.UTC)


def as_day(value: str | dt.date | dt.datetime) -> dt.date:
    return as_utc(value).date()


def timestamp_literal(value: str | dt.date | dt.datetime) -> Column:
    moment = as_utc(value)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))
