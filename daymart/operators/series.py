"""The daily series, and events joined to it by calendar day."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.functions.convert import strict_cast
from daymart.operators.lookup import BROADCAST_BYTES, SALTS, row_salt, stored_bytes
from daymart.operators.scratch import settle
from daymart.schemas import (
    EVENT_TIME,
    SERIES_ARRAYS,
    SERIES_DATE,
    SERIES_FIRST_DAY,
    SERIES_LAST_DAY,
    SERIES_VALUES,
)


def unzip_daily(payloads: DataFrame) -> DataFrame:
    """One row per day from payloads of parallel arrays under ``daily``.

    Fails when ``daily`` or one of its arrays is missing, or when the arrays
    differ in length. A null inside an array stays a null value; NaN becomes
    null, so that means skip it.
    """
    arrays = [F.col(f"daily.{name}") for name in SERIES_ARRAYS]
    lengths = [F.coalesce(F.size(array), F.lit(-1)) for array in arrays]
    unequal = reduce(or_, (length != lengths[0] for length in lengths[1:]), lengths[0] < 0)
    checked = (
        F.when(F.col("daily").isNull(), F.raise_error(F.lit("payload has no daily data")))
        .when(unequal, F.raise_error(F.lit("daily arrays are missing or differ in length")))
        .otherwise(F.arrays_zip(*arrays))
    )
    rows = payloads.select(F.inline(checked)).toDF(*SERIES_ARRAYS.values())
    return rows.select(
        strict_cast(F.col(SERIES_DATE), "date").alias(SERIES_DATE),
        *(F.nanvl(F.col(name), F.lit(None).cast("double")).alias(name) for name in SERIES_VALUES),
    )


def within_days(
    series: DataFrame,
    first: str | date = SERIES_FIRST_DAY,
    last: str | date = SERIES_LAST_DAY,
) -> DataFrame:
    """Series days from ``first`` to ``last``, both included."""
    return series.filter(F.col(SERIES_DATE).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def keyed_replace(loads: DataFrame, key: str = SERIES_DATE, version: str = "loaded_at") -> DataFrame:
    """The newest row of each ``key`` by ``version``.

    An aggregate, not a window: copies of a key collapse before the shuffle,
    so a day loaded many times is no hot group. Rows of one version are told
    apart by their values, which makes a rerun give the same row.
    """
    others = [name for name in loads.columns if name not in (key, version)]
    newest = loads.groupBy(key).agg(F.max(F.struct(version, *others)).alias("_row"))
    return newest.select(*(F.col(key) if name == key else F.col(f"_row.`{name}`") for name in loads.columns))


def integrate(events: DataFrame, series: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Events with the series values of their day; events without one drop out.

    ``series`` should be stored: its size decides how it is joined. A series
    with several rows for a day repeats that day's events. Loads that were
    appended over and over are mostly equal rows; these are counted, which
    makes the series small again, and unrolled after the join. A series that is
    large all the same is repeated for each of ``SALTS`` shares of the events,
    so days, which are few, never decide alone where an event goes.
    """
    by_day = events.withColumn(EVENT_TIME, F.col(EVENT_TIME).cast("date"))
    if stored_bytes(series) <= max_bytes:
        return by_day.join(F.broadcast(series), F.col(EVENT_TIME) == F.col(f"`{SERIES_DATE}`"), "inner")
    copies, names = "_copies", series.columns
    counted = settle(series.groupBy(*(f"`{c}`" for c in names)).agg(F.count(F.lit(1)).alias(copies)), "series-rows")
    if stored_bytes(counted) <= max_bytes:
        joined = by_day.join(F.broadcast(counted), F.col(EVENT_TIME) == F.col(f"`{SERIES_DATE}`"), "inner")
    else:
        shared = counted.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = by_day.withColumn("_salt", row_salt(by_day))
        same = (F.col(EVENT_TIME) == F.col(f"`{SERIES_DATE}`")) & (F.col("_salt") == F.col("_share"))
        joined = dealt.join(shared, same, "inner").drop("_salt", "_share")
    unrolled = joined.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))).alias("_copy"))
    return unrolled.drop(copies, "_copy")
