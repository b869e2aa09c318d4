"""Properties that hold for any input, on the order tables."""

import pytest
from pyspark.sql import functions as F

from daymart.functions import PRECIPITATION_BANDS, TEMPERATURE_BANDS, cut
from daymart.plans import build_star, stage_events
from daymart.plans.order_events import stored_integrated
from daymart.schemas import LOCATION_KEYS, MEASURES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def integrated(spark):
    return stored_integrated(spark, SF_DIR)


@pytest.fixture(scope="module")
def star(integrated):
    return build_star(integrated)


@pytest.mark.parametrize(
    "table, key",
    [
        ("dim_date", "date_key"),
        ("dim_location", "location_key"),
        ("dim_accident_type", "accident_type_key"),
        ("dim_weather", "weather_key"),
    ],
)
def test_keys_are_dense(star, table, key):
    dimension = getattr(star, table)
    low, high, rows, distinct = dimension.agg(
        F.min(key), F.max(key), F.count(F.lit(1)), F.countDistinct(key)
    ).first()
    assert (low, high, distinct) == (1, rows, rows)
    assert dict(dimension.dtypes)[key] == "bigint"


def test_fact_has_every_distinct_event(integrated, star):
    assert star.fact.count() == stage_events(integrated).distinct().count()


def test_fact_keys_lead_to_the_events_own_attributes(integrated, star):
    events = stage_events(integrated)
    joined = (
        star.fact.join(star.dim_date.select("date_key", "full_date"), "date_key")
        .join(star.dim_location, "location_key")
        .join(star.dim_weather.select("weather_key", "weather_date"), "weather_key")
        .join(star.dim_accident_type, "accident_type_key", "left")
    )
    columns = ["accident_id", *MEASURES, *LOCATION_KEYS]
    found = joined.select(*columns, F.col("full_date").alias("accident_date"), F.col("weather_date"))
    wanted = events.select(*columns, "accident_date", F.col("accident_date").alias("weather_date"))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()

    types = joined.select("accident_id", "accident_type", "accident_detail", F.col("drunk_driver_involved").cast("double"))
    flagged = events.filter("drunk_driver_involved IS NOT NULL")
    wanted = flagged.select("accident_id", "accident_type", "accident_detail", "drunk_driver_involved")
    assert types.filter("accident_type IS NOT NULL").exceptAll(wanted).isEmpty()
    assert types.filter("accident_type IS NULL").count() == events.count() - flagged.count()


@pytest.mark.parametrize(
    "column, bands", [("temperature_min", TEMPERATURE_BANDS), ("precipitation_sum", PRECIPITATION_BANDS)]
)
def test_bands_and_the_rest_make_the_input(integrated, column, bands):
    outside = F.col(column) <= bands.edges[0]
    banded = integrated.groupBy(cut(F.col(column), bands).alias("band")).count().collect()
    in_bands = sum(row["count"] for row in banded if row["band"] is not None)
    assert in_bands + integrated.filter(outside).count() == integrated.count()


def test_a_rerun_gives_the_same_star(integrated, star):
    again = build_star(integrated)
    for table in ("dim_date", "dim_location", "dim_accident_type", "dim_weather", "fact"):
        first, second = getattr(star, table), getattr(again, table)
        assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
