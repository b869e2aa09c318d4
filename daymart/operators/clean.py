"""Cleaning and validation of raw event records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.convert import is_digits, is_present, strict_cast
from daymart.functions.days import strict_timestamp
from daymart.schemas import (
    ALLOWED_REGIONS,
    ALLOWED_SETTLEMENTS,
    CASE_NUMBER,
    CLEAN_EVENTS,
    KEPT_COLUMNS,
    REGION,
    SETTLEMENT,
)


def clean_events(raw: DataFrame, time_format: str) -> DataFrame:
    """Typed events: kept columns only, no nulls, all-digit case numbers.

    ``raw`` holds text columns. A missing kept column is an error, and so is
    a text that does not read as its column's type in a row that is kept.
    """
    # One condition per column: a single one over all thirty (``dropna``) makes
    # the optimizer derive it anew for every subset of columns renamed later.
    kept = raw.select(*KEPT_COLUMNS)
    whole = kept.filter(" AND ".join(map(is_present, KEPT_COLUMNS)))
    numbered = whole.filter(is_digits(F.col(CASE_NUMBER)))

    def typed(field: T.StructField):
        text = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return text
        if isinstance(field.dataType, T.TimestampNTZType):
            return strict_timestamp(text, time_format).alias(field.name)
        return strict_cast(text, field.dataType.simpleString()).alias(field.name)

    return numbered.select(*map(typed, CLEAN_EVENTS.fields))


def validate_events(
    events: DataFrame,
    regions: list[str] = ALLOWED_REGIONS,
    settlements: list[str] = ALLOWED_SETTLEMENTS,
) -> DataFrame:
    """Keep events in an allowed region with an allowed settlement mark."""
    return events.filter(F.col(REGION).isin(regions) & F.col(SETTLEMENT).isin(settlements))
