"""Column expressions. All run inside the JVM; none is a Python UDF."""

from daymart.functions.bands import PRECIPITATION_BANDS, TEMPERATURE_BANDS, Bands, cut
from daymart.functions.convert import flag_to_boolean, is_digits, is_present, strict_cast
from daymart.functions.days import (
    day_parts,
    lenient_day,
    month_start,
    strict_timestamp,
    timestamp_text,
)
from daymart.functions.geo import grid_cell, to_wgs84

__all__ = [
    "Bands",
    "PRECIPITATION_BANDS",
    "TEMPERATURE_BANDS",
    "cut",
    "day_parts",
    "flag_to_boolean",
    "grid_cell",
    "is_digits",
    "is_present",
    "lenient_day",
    "month_start",
    "strict_cast",
    "strict_timestamp",
    "timestamp_text",
    "to_wgs84",
]
