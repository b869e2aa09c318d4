"""Report frames over the integrated table.

Banded and monthly reports shrink to a handful of rows in the map-side
aggregate, so only those rows shuffle; map layers stay frames to be written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.functions.bands import PRECIPITATION_BANDS, TEMPERATURE_BANDS, Bands, cut
from daymart.functions.days import month_start
from daymart.functions.geo import grid_cell, to_wgs84
from daymart.operators.scratch import settle
from daymart.schemas import (
    DEATHS,
    EASTING,
    EVENT_TIME,
    INJURIES,
    NORTHING,
    PEOPLE,
    REGION,
    SERIES_DATE,
    TYPE,
    VEHICLES,
)

BAND_INDEX = "band_idx"


def _by_band(df: DataFrame, column: str, bands: Bands, label: str, measures: dict[str, Column]) -> DataFrame:
    """Measures per band, every band listed, in band order.

    Both sides of the join have at most one row per band.
    """
    banded = df.withColumn(BAND_INDEX, cut(F.col(column), bands)).filter(F.col(BAND_INDEX).isNotNull())
    totals = banded.groupBy(BAND_INDEX).agg(*(value.alias(name) for name, value in measures.items()))
    listed = bands.table(df.sparkSession, BAND_INDEX, label)
    return listed.join(F.broadcast(totals), BAND_INDEX, "left").orderBy(BAND_INDEX)


def severity_by_temperature(
    integrated: DataFrame,
    temperature: str = "temperature_min",
    injuries: str = INJURIES,
    deaths: str = DEATHS,
    bands: Bands = TEMPERATURE_BANDS,
) -> DataFrame:
    """Mean injuries and deaths per event by temperature band; null where none fell."""
    measures = {"Injuries": F.avg(injuries), "Fatalities": F.avg(deaths)}
    return _by_band(integrated, temperature, bands, "temperature_category", measures)


def involved_by_precipitation(
    integrated: DataFrame,
    precipitation: str = "precipitation_sum",
    vehicles: str = VEHICLES,
    people: str = PEOPLE,
    bands: Bands = PRECIPITATION_BANDS,
) -> DataFrame:
    """Vehicles and people by precipitation band; 0 where none fell.

    Dry days are in no band: the lowest one is open at 0.
    """
    measures = {"Vehicles": F.sum(vehicles), "People": F.sum(people)}
    report = _by_band(integrated, precipitation, bands, "precipitation_category", measures)
    return report.fillna(0, list(measures))


def _sum(column: str) -> Column:
    """Sum that is 0, not null, when every value is null."""
    return F.coalesce(F.sum(column), F.lit(0))


def monthly_trend(
    integrated: DataFrame,
    day: str = SERIES_DATE,
    people: str = PEOPLE,
    precipitation: str = "precipitation_sum",
    temperature_min: str = "temperature_min",
    temperature_max: str = "temperature_max",
    weighting: str = "event",
) -> DataFrame:
    """People, precipitation and mean temperatures per month.

    One aggregate serves all columns, as the event's day and the series' day
    are the same after the join. With ``weighting="event"`` a day's weather
    counts once per event on it; with ``"day"``, once.
    """
    columns = integrated.select(day, people, precipitation, temperature_min, temperature_max)
    rows = columns.filter(F.col(day).isNotNull())
    if weighting == "day":
        weather = [F.max(name).alias(name) for name in (precipitation, temperature_min, temperature_max)]
        rows = rows.groupBy(day).agg(F.sum(people).alias(people), *weather)
    elif weighting != "event":
        raise ValueError(f"unknown weighting {weighting!r}")

    by_month = rows.groupBy(month_start(F.col(day)).alias("YearMonth")).agg(
        _sum(people).alias("people"),
        _sum(precipitation).alias("precipitation"),
        F.avg(temperature_min).alias("temperature_min"),
        F.avg(temperature_max).alias("temperature_max"),
    )
    return _with_mean_temperature(by_month)


def monthly_trend_joined(
    integrated: DataFrame,
    event_day: str = EVENT_TIME,
    series_day: str = SERIES_DATE,
    people: str = PEOPLE,
    precipitation: str = "precipitation_sum",
    temperature_min: str = "temperature_min",
    temperature_max: str = "temperature_max",
) -> DataFrame:
    """``monthly_trend`` for tables whose event and series days differ.

    Two monthly aggregates joined on the month; both are bounded by the
    calendar.
    """
    involved = (
        integrated.filter(F.col(event_day).isNotNull())
        .groupBy(month_start(F.col(event_day)).alias("YearMonth"))
        .agg(_sum(people).alias("people"), _sum(precipitation).alias("precipitation"))
    )
    weather = (
        integrated.filter(F.col(series_day).isNotNull())
        .groupBy(month_start(F.col(series_day)).alias("YearMonth"))
        .agg(F.avg(temperature_min).alias("temperature_min"), F.avg(temperature_max).alias("temperature_max"))
    )
    return _with_mean_temperature(involved.join(weather, "YearMonth", "inner"))


def _with_mean_temperature(by_month: DataFrame) -> DataFrame:
    middle = (F.col("temperature_min") + F.col("temperature_max")) / 2
    return by_month.withColumn("temperature_avg", middle)


def count_by_region_type(integrated: DataFrame, region: str = REGION, kind: str = TYPE) -> DataFrame:
    """Number of events per region and type."""
    return integrated.groupBy(region, kind).agg(F.count(F.lit(1)).alias("total_accidents"))


def map_points(integrated: DataFrame, easting: str = EASTING, northing: str = NORTHING) -> DataFrame:
    """One map point per event: position, precipitation, injuries and day."""
    longitude, latitude = to_wgs84(F.col(easting), F.col(northing))
    # The names that readers of the layer expect.
    return integrated.select(
        latitude.alias("Latitude"),
        longitude.alias("Longitude"),
        F.col("precipitation_sum").alias("Precipitation (mm)"),
        F.col(INJURIES).alias("Injured"),
        F.col(SERIES_DATE).alias("Date"),
    )


def density_grid(
    integrated: DataFrame,
    size: float,
    weight: str = PEOPLE,
    easting: str = EASTING,
    northing: str = NORTHING,
) -> DataFrame:
    """Weight and number of events per ``size``-metre cell, with the cell's centre.

    Cells are counted in grid metres; only the cells are projected.
    """
    cells = integrated.select(
        grid_cell(F.col(easting), size).alias("cell_x"),
        grid_cell(F.col(northing), size).alias("cell_y"),
        weight,
    ).filter(F.col("cell_x").isNotNull() & F.col("cell_y").isNotNull())
    totals = cells.groupBy("cell_x", "cell_y").agg(_sum(weight).alias("weight"), F.count(F.lit(1)).alias("events"))
    longitude, latitude = to_wgs84((F.col("cell_x") + 0.5) * size, (F.col("cell_y") + 0.5) * size)
    return totals.withColumns({"Longitude": longitude, "Latitude": latitude})


def weight_around(
    integrated: DataFrame,
    radius: float,
    weight: str = PEOPLE,
    easting: str = EASTING,
    northing: str = NORTHING,
) -> DataFrame:
    """Weight and number of events within ``radius`` metres of each location, the rim included.

    Events of one location are summed first, so a place with very many of them
    is one row. Cells are half a radius wide: all of a cell's places that lies
    wholly within the radius counts by the cell's sum, its own cell always; only
    places of cells on the rim are compared, by their exact distance.

    Each place is repeated for tens of cells, of which the planner's size, that
    of the stored places, knows nothing: both sides are merged, none is broadcast.
    """
    size = radius / 2
    places = integrated.filter(F.col(easting).isNotNull() & F.col(northing).isNotNull())
    places = places.groupBy(F.col(easting).alias("x"), F.col(northing).alias("y")).agg(
        _sum(weight).alias("weight"), F.count(F.lit(1)).alias("events")
    )
    places = settle(places.withColumns({"cx": grid_cell(F.col("x"), size), "cy": grid_cell(F.col("y"), size)}), "places")
    cells = places.groupBy(F.col("cx").alias("nx"), F.col("cy").alias("ny")).agg(
        _sum("weight").alias("weight"), F.sum("events").alias("events")
    )
    steps = F.sequence(F.lit(-3), F.lit(3))
    around = places.select("x", "y", "cx", "cy", F.explode(steps).alias("dx"))
    around = around.select("x", "y", "cy", (F.col("cx") + F.col("dx")).alias("nx"), F.explode(steps).alias("dy"))
    around = around.select("x", "y", "nx", (F.col("cy") + F.col("dy")).alias("ny"))
    near, far = F.lit(0.0), F.lit(0.0)
    for at, cell in (("x", "nx"), ("y", "ny")):
        low, high = F.col(cell) * size - F.col(at), (F.col(cell) + 1) * size - F.col(at)
        near = near + F.pow(F.greatest(low, -high, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(F.abs(low), F.abs(high)), 2)
    # Where rounding could decide, places are compared.
    around = around.select("x", "y", "nx", "ny", (far <= radius * radius * (1 - 1e-9)).alias("within"), near.alias("near"))
    around = around.filter(F.col("near") <= radius * radius * (1 + 1e-9)).drop("near")
    whole = around.filter("within").join(cells.hint("merge"), ["nx", "ny"]).select("x", "y", "weight", "events")
    others = places.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("x").alias("px"), F.col("y").alias("py"), "weight", "events")
    apart = F.pow(F.col("px") - F.col("x"), 2) + F.pow(F.col("py") - F.col("y"), 2)
    rim = around.filter("not within").join(others.hint("merge"), ["nx", "ny"]).filter(apart <= radius * radius)
    found = whole.unionByName(rim.select("x", "y", "weight", "events"))
    return found.groupBy("x", "y").agg(_sum("weight").alias("weight"), F.sum("events").alias("events"))


def latest_rows(log: DataFrame, newest: str, tie: str, rows: int = 100) -> DataFrame:
    """The newest ``rows`` of a log, newest first. Each task keeps only its own newest."""
    return log.orderBy(F.col(newest).desc(), F.col(tie).desc()).limit(rows)


def first_rows(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first ``rows`` by ``key``."""
    return df.orderBy(key).limit(rows)
