"""Dates and timestamps. Timestamps carry no zone, so days never shift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymart.functions.convert import or_raise


def strict_timestamp(text: Column, time_format: str) -> Column:
    """Text -> timestamp without zone; bad text is an error."""
    return or_raise(F.to_timestamp_ntz(text, F.lit(time_format)), text, "timestamp")


def lenient_day(text: Column) -> Column:
    """Text, date or timestamp -> day; bad text becomes null."""
    return text.try_cast("date")


def timestamp_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp without zone.

    The cast needs no session zone; ``date_format`` would go through one and
    move clock times that fall in a daylight-saving gap.
    """
    return F.substring(moment.cast("timestamp_ntz").cast("string"), 1, 19)


def month_start(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "MM")


def day_parts(day: Column) -> dict[str, Column]:
    """Year, month, day and weekday (Sunday = 0) as bigint."""
    parts = {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day) - 1,
    }
    return {name: part.cast("bigint") for name, part in parts.items()}
