"""National grid to WGS84, and grid cells, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# EPSG:3301, a Lambert conformal conic projection with two
# standard parallels on the GRS80 ellipsoid (no datum shift to EPSG:4326).
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
ORIGIN_LATITUDE = 57 + 31 / 60 + 3.19415 / 3600
ORIGIN_LONGITUDE = 24.0
PARALLELS = (58.0, 59 + 20 / 60)
FALSE_EASTING = 500_000.0
FALSE_NORTHING = 6_375_000.0

# Each pass shrinks the latitude error by about e**2 = 0.0067.
LATITUDE_PASSES = 5


def _cone() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, radius scale and radius at the origin."""
    flattening = 1 / INVERSE_FLATTENING
    e = math.sqrt(flattening * (2 - flattening))

    def isometric(latitude: float) -> float:
        sine = math.sin(math.radians(latitude))
        return math.atanh(sine) - e * math.atanh(e * sine)

    def parallel_radius(latitude: float) -> float:
        phi = math.radians(latitude)
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    south, north = PARALLELS
    n = math.log(parallel_radius(south) / parallel_radius(north)) / (isometric(north) - isometric(south))
    scale = SEMI_MAJOR * parallel_radius(south) / n * math.exp(n * isometric(south))
    return e, n, scale, scale * math.exp(-n * isometric(ORIGIN_LATITUDE))


ECCENTRICITY, CONE, RADIUS_SCALE, ORIGIN_RADIUS = _cone()


def to_wgs84(easting: Column, northing: Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of a grid point in metres.

    Closed form but for the latitude, which takes a fixed number of passes;
    each pass uses the one before it once, so the expression stays linear in
    size.
    """
    east = easting - FALSE_EASTING
    south = ORIGIN_RADIUS - (northing - FALSE_NORTHING)
    longitude = F.degrees(F.atan2(east, south) / CONE) + ORIGIN_LONGITUDE
    isometric = F.log(F.lit(RADIUS_SCALE) / F.hypot(east, south)) / CONE

    sine = F.tanh(isometric)
    for _ in range(LATITUDE_PASSES):
        sine = F.tanh(isometric + ECCENTRICITY * F.atanh(ECCENTRICITY * sine))
    return longitude, F.degrees(F.asin(sine))


def grid_cell(value: Column, size: float, origin: float = 0.0) -> Column:
    """Index of the ``size``-wide cell that holds ``value``."""
    return F.floor((value - origin) / size).cast("bigint")
