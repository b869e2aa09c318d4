"""Right-closed banding of a numeric column."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """``len(edges) - 1`` intervals ``(lower, upper]``, each with a label."""

    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("bands need one label per interval")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("band edges must rise")

    def table(self, spark: SparkSession, index: str, label: str) -> DataFrame:
        """One row per band, empty ones included, in order in one partition."""
        names = F.array(*map(F.lit, self.labels))
        return spark.range(0, len(self.labels), 1, 1).select(
            F.col("id").cast("int").alias(index),
            F.get(names, F.col("id").cast("int")).alias(label),
        )


# Edges and labels of the two banded reports.
TEMPERATURE_BANDS = Bands(
    edges=(-math.inf, -10.0, 0.0, 10.0, 20.0, math.inf),
    labels=("< -10°C", "-10°C to 0°C", "0°C to 10°C", "10°C to 20°C", "> 20°C"),
)
PRECIPITATION_BANDS = Bands(
    edges=(0.0, 10.0, 20.0, 30.0, math.inf),
    labels=("0-10 mm", "10-20 mm", "20-30 mm", "> 30 mm"),
)


def cut(value: Column, bands: Bands) -> Column:
    """0-based band of ``value``; null when it is null, NaN or in no band.

    A ``CASE`` chain, so it stays in whole-stage codegen. The stock bucketizer
    closes its intervals on the left and would move every edge value up a band.
    """
    lowest, *uppers = bands.edges
    inside = F.when(value.isNull() | F.isnan(value) | (value <= F.lit(lowest)), None)
    if lowest == -math.inf:
        inside = F.when(value.isNull() | F.isnan(value), None)
    for band, upper in enumerate(uppers):
        inside = inside.when(value <= F.lit(upper), F.lit(band))
    return inside
