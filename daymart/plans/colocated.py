"""The fact over events stored in buckets of their location.

``locate_events`` shuffles the events once. The keys of locations, distinct
events and the location lookup read its buckets, and the other lookups are
broadcast when their size allows, so no event moves again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.functions.convert import flag_to_boolean
from daymart.operators.colocate import PLACE, SPREAD, bucket_count, co_locate, key_places
from daymart.operators.keys import COUNT
from daymart.operators.lookup import BROADCAST_BYTES, HOT_KEYS, lookup_key
from daymart.plans.star import FLAG, all_present, day_keys, type_mapping
from daymart.schemas import LOCATION_KEYS, MEASURES, TYPE_KEYS

#: Columns of the fact that equal events agree in.
_SPREAD_BY = ["accident_id", *MEASURES]


def locate_events(events: DataFrame, table: str, *, buckets: int | None = None, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Staged events in buckets of their location; the only shuffle of them."""
    return co_locate(events, LOCATION_KEYS, _SPREAD_BY, table, buckets=buckets, hot_keys=hot_keys)


def locations_of(table: str, events: DataFrame) -> DataFrame:
    """Location keys of the parts of ``table``, in its buckets."""
    return key_places(events, LOCATION_KEYS, "location_key", f"{table}_keys", bucket_count(events.sparkSession, table))


def located_fact(
    events: DataFrame,
    series: DataFrame,
    locations: DataFrame,
    types: DataFrame | None = None,
    *,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The fact, row for row, of events stored by ``locate_events``.

    Events are made distinct within their buckets first and meet their keys after.
    """
    types = type_mapping(events) if types is None else types
    natural = ["accident_id", "accident_date", *TYPE_KEYS, *MEASURES]
    distinct = events.select(PLACE, SPREAD, all_present(LOCATION_KEYS).alias("_located"), *natural).distinct()
    keyed = distinct.join(locations.select(PLACE, SPREAD, "location_key"), [PLACE, SPREAD])
    days = F.broadcast(day_keys(events, series))
    dated = keyed.join(days, keyed["accident_date"] == days["full_date"], "left").drop("full_date", PLACE, SPREAD)
    typed = dated.withColumn(FLAG, flag_to_boolean(F.col(FLAG)))
    rows = lookup_key(typed, types, TYPE_KEYS, ["accident_type_key"], count_column=COUNT, max_bytes=max_bytes)
    return rows.select(
        "accident_id",
        "date_key",
        F.when(F.col("_located"), F.col("location_key")).alias("location_key"),
        F.when(all_present(TYPE_KEYS), F.col("accident_type_key")).alias("accident_type_key"),
        "weather_key",
        *MEASURES,
    )
