"""Keys and parts of event times used by the star schema."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F, types as T


def date_key(ts: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """``HHMM`` as an integer."""
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def month_key(date_sk: Column) -> Column:
    """``YYYYMM`` of a date key: the partition column of a fact table."""
    return F.floor(date_sk / 100).cast("int")


def clock_text(hour: Column, minute: Column) -> Column:
    """``HH:MM`` with leading zeros."""
    return F.concat(
        F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0")
    )


def as_utc(moment: datetime) -> datetime:
    """Aware UTC time; a time without a zone is UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def instant(moment: datetime, dtype: T.DataType | str = "timestamp") -> Column:
    """Literal that does not depend on the driver's local time zone."""
    text = as_utc(moment).replace(tzinfo=None).isoformat(" ")
    return F.lit(text).cast("timestamp_ntz").cast(dtype)
