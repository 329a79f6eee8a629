"""Rows still within a topic's lifecycle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.schema import ARRIVAL_DATE, SYSTEM_TIME


def retained(df: DataFrame, days: int, as_of: dt.datetime | Column) -> DataFrame:
    """The records that arrived in the ``days`` days up to ``as_of``. Files are left as they are.

    The bound is a constant by the time the plan reaches the scan: of a topic's records, whole days before it are never
    listed, and row groups older than it are skipped. A datetime without a zone means UTC.
    """
    if isinstance(as_of, dt.datetime):
        as_of = F.timestamp_micros(F.lit(_micros(as_of)))
    bound = as_of - F.make_dt_interval(days=F.lit(days))
    if ARRIVAL_DATE in df.columns:
        df = df.where(F.col(ARRIVAL_DATE) >= utc_day(bound))
    return df.where(F.col(SYSTEM_TIME) >= bound)


def utc_day(instant: Column) -> Column:
    """The day of an instant in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / F.lit(86_400_000_000)).cast("int"))


def utc_date(instant: dt.datetime) -> dt.date:
    zoned = instant if instant.tzinfo else instant.replace(tzinfo=dt.timezone.utc)
    return zoned.astimezone(dt.timezone.utc).date()


def _micros(instant: dt.datetime) -> int:
    zoned = instant if instant.tzinfo else instant.replace(tzinfo=dt.timezone.utc)
    return (zoned - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
