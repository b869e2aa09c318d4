"""Star schema over the integrated table: staging, dimensions and the fact.

Dimensions come in two modes. ``conformed`` numbers each distinct natural key
once, so its keys are the ones in the fact. ``as_written`` numbers every
staged row; the fact, which always numbers distinct keys, does not join to it.

Pass a stored integrated table: every dimension and the fact scan it, each
with the columns it needs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.functions.convert import flag_to_boolean
from daymart.functions.days import day_parts
from daymart.operators.keys import COUNT, dense_keys, expand_rows, rank_tuples
from daymart.operators.lookup import BROADCAST_BYTES, HOT_KEYS, broadcast_if_small, lookup_key
from daymart.operators.scratch import settle
from daymart.schemas import (
    LOCATION_KEYS,
    MEASURES,
    STAGED_EVENT_COLUMNS,
    STAGED_SERIES_COLUMNS,
    TYPE_KEYS,
)

FLAG = "drunk_driver_involved"
MODES = ("conformed", "as_written")


def _renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in columns.items()))


def stage_events(integrated: DataFrame, columns: dict[str, str] = STAGED_EVENT_COLUMNS) -> DataFrame:
    """Event columns under their model names."""
    return _renamed(integrated, columns)


def stage_series(integrated: DataFrame, columns: dict[str, str] = STAGED_SERIES_COLUMNS) -> DataFrame:
    """Series columns under their model names, one row per integrated row."""
    return _renamed(integrated, columns)


def _day_number(day: str) -> Column:
    # Distinct days are bounded by the calendar, so one task can number them.
    return F.row_number().over(W.orderBy(F.col(day).asc_nulls_last())).cast("bigint")


def _days(events: DataFrame, series: DataFrame) -> DataFrame:
    """Every event day and series day once, and whether the series has it (1 or 0)."""
    event_days = events.select(F.col("accident_date").cast("date").alias("full_date"), F.lit(0).alias("in_series"))
    series_days = series.select(F.col("weather_date").cast("date").alias("full_date"), F.lit(1).alias("in_series"))
    return event_days.union(series_days).groupBy("full_date").agg(F.max("in_series").alias("in_series"))


def dim_date(events: DataFrame, series: DataFrame) -> DataFrame:
    """Every event day and series day once, numbered in order."""
    parts = [part.alias(name) for name, part in day_parts(F.col("full_date")).items()]
    numbered = _days(events, series).select(_day_number("full_date").alias("date_key"), "full_date", *parts)
    return numbered.orderBy(F.col("full_date").asc_nulls_last())


def dim_time(dates: DataFrame) -> DataFrame:
    """Date and year of each row of ``dim_date``."""
    return dates.select(F.col("full_date").alias("date"), "year")


def location_mapping(events: DataFrame) -> DataFrame:
    """Key, natural key and event count of each location, over stored tuples."""
    return dense_keys(rank_tuples(events, LOCATION_KEYS), LOCATION_KEYS, "location_key")


def type_mapping(events: DataFrame) -> DataFrame:
    """Key, natural key and event count of each event type, over stored tuples."""
    typed = events.withColumn(FLAG, flag_to_boolean(F.col(FLAG)))
    return dense_keys(rank_tuples(typed, TYPE_KEYS), TYPE_KEYS, "accident_type_key")


def dim_location(events: DataFrame, mode: str = "conformed") -> DataFrame:
    if _conformed(mode):
        return location_mapping(events).drop(COUNT)
    return expand_rows(rank_tuples(events, LOCATION_KEYS), LOCATION_KEYS, "location_key")


def dim_accident_type(events: DataFrame, mode: str = "conformed") -> DataFrame:
    if _conformed(mode):
        return type_mapping(events).drop(COUNT)
    rows = expand_rows(rank_tuples(events, TYPE_KEYS), TYPE_KEYS, "accident_type_key")
    return rows.withColumn(FLAG, flag_to_boolean(F.col(FLAG)))


def dim_weather(series: DataFrame, mode: str = "conformed") -> DataFrame:
    """Series values per day; reading ``conformed`` fails when a day has two sets of values."""
    day, *values = STAGED_SERIES_COLUMNS.values()
    if not _conformed(mode):
        return expand_rows(rank_tuples(series, [day, *values]), [day, *values], "weather_key")
    # Equal rows collapse in a hash aggregate first; what is left is about one
    # row per day.
    record = F.struct(*values)
    per_day = series.select(day, *values).distinct().groupBy(day).agg(F.min(record).alias("low"), F.max(record).alias("high"))
    problem = F.concat(F.lit("the series has different rows for "), F.coalesce(F.col(day).cast("string"), F.lit("no day")))
    only = F.when(F.col("low").eqNullSafe(F.col("high")), F.col("low")).otherwise(F.raise_error(problem))
    numbered = per_day.select(_day_number(day).alias("weather_key"), day, only.alias("only"))
    return numbered.select("weather_key", day, *(F.col(f"only.{name}") for name in values))


def _conformed(mode: str) -> bool:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    return mode == "conformed"


def day_keys(events: DataFrame, series: DataFrame) -> DataFrame:
    """Date key and series key of each day, the latter null on days without a series row.

    One window, bounded by the calendar, gives the numbers ``row_number``
    would give each table's days.
    """
    in_order = W.orderBy(F.col("full_date").asc_nulls_last())
    so_far = F.sum("in_series").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return _days(events, series).select(
        "full_date",
        F.row_number().over(in_order).cast("bigint").alias("date_key"),
        F.when(F.col("in_series") == 1, so_far).alias("weather_key"),
    )


def all_present(columns: list[str]) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def fact(
    events: DataFrame,
    series: DataFrame,
    locations: DataFrame | None = None,
    types: DataFrame | None = None,
    *,
    max_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """One row per distinct event with its four keys and its measures.

    A natural key with a null in it has a null key. Events first swap their
    wide natural keys for numbers (nulls numbered too, so two different
    events stay different) and are made distinct afterwards, which keeps the
    one shuffle of all events narrow. ``locations`` and ``types`` default to
    the mappings of ``events``.
    """
    locations = location_mapping(events) if locations is None else locations
    types = type_mapping(events) if types is None else types
    limits = {"count_column": COUNT, "max_bytes": max_bytes, "hot_keys": hot_keys}

    raw_flag = "_raw_flag"
    typed = events.withColumn(raw_flag, F.col(FLAG)).withColumn(FLAG, flag_to_boolean(F.col(FLAG)))
    days = F.broadcast(day_keys(events, series))
    rows = typed.join(days, typed["accident_date"] == days["full_date"], "left").drop("full_date")
    rows = lookup_key(rows, types, TYPE_KEYS, ["accident_type_key"], **limits)
    rows = lookup_key(rows, locations, LOCATION_KEYS, ["location_key"], **limits)

    distinct = rows.select(
        "accident_id",
        "date_key",
        "weather_key",
        F.col("location_key").alias("_location"),
        F.col("accident_type_key").alias("_type"),
        raw_flag,
        all_present(LOCATION_KEYS).alias("_located"),
        all_present(TYPE_KEYS).alias("_typed"),
        *MEASURES,
    ).distinct()
    return distinct.select(
        "accident_id",
        "date_key",
        F.when(F.col("_located"), F.col("_location")).alias("location_key"),
        F.when(F.col("_typed"), F.col("_type")).alias("accident_type_key"),
        "weather_key",
        *MEASURES,
    )


def fact_wide(facts: DataFrame, weather: DataFrame) -> DataFrame:
    """The fact with its day's maximum temperature, from the conformed series dimension.

    A dimension with several rows for a day is refused: it is the one as
    written, whose keys are not the fact's.
    """
    stored = settle(weather.select("weather_key", "weather_date", "max_temperature"), "weather")
    if not stored.groupBy("weather_date").count().filter(F.col("count") > 1).isEmpty():
        raise ValueError("the series dimension has several rows for a day; the fact's keys are those of the conformed one")
    by_key = broadcast_if_small(stored.select("weather_key", "max_temperature"))
    return facts.join(by_key, "weather_key", "left").select(*facts.columns, "max_temperature")


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_location: DataFrame
    dim_accident_type: DataFrame
    dim_weather: DataFrame
    fact: DataFrame


def build_star(integrated: DataFrame, mode: str = "conformed") -> Star:
    """All dimensions and the fact of a stored integrated table."""
    conformed = _conformed(mode)
    events, series = stage_events(integrated), stage_series(integrated)
    locations, types = location_mapping(events), type_mapping(events)
    return Star(
        dim_date=dim_date(events, series),
        dim_location=locations.drop(COUNT) if conformed else dim_location(events, mode),
        dim_accident_type=types.drop(COUNT) if conformed else dim_accident_type(events, mode),
        dim_weather=dim_weather(series, mode),
        fact=fact(events, series, locations, types),
    )
