"""Compositions: staging, star schema and reports."""

from daymart.plans.reports import (
    count_by_region_type,
    density_grid,
    first_rows,
    involved_by_precipitation,
    latest_rows,
    map_points,
    monthly_trend,
    monthly_trend_joined,
    severity_by_temperature,
)
from daymart.plans.colocated import locate_events, located_fact, locations_of
from daymart.plans.star import (
    Star,
    build_star,
    dim_accident_type,
    dim_date,
    dim_location,
    dim_time,
    dim_weather,
    fact,
    fact_wide,
    stage_events,
    stage_series,
)

__all__ = [
    "Star",
    "build_star",
    "count_by_region_type",
    "density_grid",
    "dim_accident_type",
    "dim_date",
    "dim_location",
    "dim_time",
    "dim_weather",
    "fact",
    "fact_wide",
    "first_rows",
    "involved_by_precipitation",
    "latest_rows",
    "locate_events",
    "located_fact",
    "locations_of",
    "map_points",
    "monthly_trend",
    "monthly_trend_joined",
    "severity_by_temperature",
    "stage_events",
    "stage_series",
]
