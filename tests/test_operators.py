"""Properties of single operators."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.functions import (
    PRECIPITATION_BANDS,
    TEMPERATURE_BANDS,
    Bands,
    cut,
    day_parts,
    flag_to_boolean,
    is_digits,
    lenient_day,
    month_start,
    timestamp_text,
    to_wgs84,
)
from daymart.functions import geo
from daymart.operators import dense_keys, expand_rows, keyed_replace, lookup_key, rank_tuples, settle, stored_bytes
from daymart.operators.keys import COUNT
from daymart.plans import fact, first_rows, latest_rows, stage_events, stage_series


def column(spark, values, expression, kind="double"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in frame.select(expression(F.col("v"))).collect()]


def test_temperature_edges_fall_in_the_lower_band(spark):
    values = [-40.0, -10.0, -9.9, 0.0, 10.0, 20.0, 20.1, None, math.nan]
    assert column(spark, values, lambda v: cut(v, TEMPERATURE_BANDS)) == [0, 0, 1, 1, 2, 3, 4, None, None]


def test_precipitation_bands_are_open_at_zero(spark):
    values = [-1.0, 0.0, 0.1, 10.0, 10.1, 30.0, 31.0, None]
    assert column(spark, values, lambda v: cut(v, PRECIPITATION_BANDS)) == [None, None, 0, 0, 1, 2, 3, None]


def test_bands_are_checked():
    with pytest.raises(ValueError):
        Bands((0.0, 1.0), ("a", "b"))
    with pytest.raises(ValueError):
        Bands((1.0, 0.0), ("a",))


def test_digits(spark):
    values = ["12", "", "1a", "12\n", "-3", "١٢", None]
    assert column(spark, values, is_digits, "string") == [True, False, False, False, False, False, None]


def test_flags(spark):
    assert column(spark, [1.0, 0.0, 2.0, None], flag_to_boolean) == [True, False, None, None]


def test_days(spark):
    assert column(spark, ["2024-01-07", "2024-01-07 10:00:00", "soon", None], lenient_day, "string") == [
        date(2024, 1, 7),
        date(2024, 1, 7),
        None,
        None,
    ]
    assert column(spark, ["2024-02-29"], lambda v: month_start(v.cast("date")), "string") == [date(2024, 2, 1)]
    weekday = column(spark, ["2024-01-06", "2024-01-07"], lambda v: day_parts(v.cast("date"))["day_of_week"], "string")
    assert weekday == [6, 0]


def test_clock_time_in_a_daylight_saving_gap(spark):
    # 03:30 does not exist in the session's zone on that day.
    assert column(spark, ["2020-03-29 03:30:00"], lambda v: timestamp_text(v.cast("timestamp_ntz")), "string") == [
        "2020-03-29 03:30:00"
    ]


def test_projection_inverts_the_forward_formula(spark):
    def forward(longitude, latitude):
        sine = math.sin(math.radians(latitude))
        iso = math.atanh(sine) - geo.ECCENTRICITY * math.atanh(geo.ECCENTRICITY * sine)
        radius = geo.RADIUS_SCALE * math.exp(-geo.CONE * iso)
        angle = geo.CONE * math.radians(longitude - geo.ORIGIN_LONGITUDE)
        return geo.FALSE_EASTING + radius * math.sin(angle), geo.FALSE_NORTHING + geo.ORIGIN_RADIUS - radius * math.cos(
            angle
        )

    rng = random.Random(7)
    places = [(rng.uniform(21.8, 28.2), rng.uniform(57.5, 59.6)) for _ in range(500)]
    grid = spark.createDataFrame([(*p, *forward(*p)) for p in places], "lon double, lat double, e double, n double")
    longitude, latitude = to_wgs84(F.col("e"), F.col("n"))
    worst = grid.select(F.max(F.abs(longitude - F.col("lon"))), F.max(F.abs(latitude - F.col("lat")))).first()
    assert max(worst) < 1e-11


def tuples(spark, rows=3_000, seed=1):
    """Tuples with nulls and many copies; a third of the rows are one tuple."""
    rng = random.Random(seed)
    hot = ("m", 5.0)
    data = [
        hot if rng.random() < 1 / 3 else (rng.choice(["a", "b", "õ", "z", None]), rng.choice([None, -1.0, 0.5, *range(200)]))
        for _ in range(rows)
    ]
    return spark.createDataFrame([(a, None if b is None else float(b)) for a, b in data], "a string, b double")


@pytest.mark.parametrize("partitions", [None, 1, 8, 50])
def test_dense_keys_equal_row_number(spark, partitions):
    frame = tuples(spark)
    order = [F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()]
    wanted = frame.distinct().withColumn("key", F.row_number().over(W.orderBy(*order)).cast("bigint"))
    found = dense_keys(rank_tuples(frame, ["a", "b"], partitions), ["a", "b"], "key")
    assert set(map(tuple, found.select("key", "a", "b").collect())) == set(
        map(tuple, wanted.select("key", "a", "b").collect())
    )
    assert found.agg(F.sum(COUNT)).first()[0] == frame.count()


@pytest.mark.parametrize("chunk", [7, 65_536])
@pytest.mark.parametrize("partitions", [None, 5])
def test_expanded_rows_equal_row_number(spark, monkeypatch, chunk, partitions):
    monkeypatch.setattr("daymart.operators.keys._CHUNK", chunk)
    monkeypatch.setattr("daymart.operators.keys._ROWS_PER_TASK", 500)
    frame = tuples(spark)
    order = [F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()]
    wanted = frame.withColumn("key", F.row_number().over(W.orderBy(*order)).cast("bigint"))
    found = expand_rows(rank_tuples(frame, ["a", "b"], partitions), ["a", "b"], "key")
    assert sorted(map(repr, found.select("key", "a", "b").collect())) == sorted(
        map(repr, wanted.select("key", "a", "b").collect())
    )


def test_keys_of_an_empty_table(spark):
    ranked = rank_tuples(tuples(spark).limit(0), ["a", "b"])
    assert dense_keys(ranked, ["a", "b"], "key").count() == 0
    assert expand_rows(ranked, ["a", "b"], "key").count() == 0


@pytest.mark.parametrize("hot_keys, hot_bytes", [(2, 1 << 26), (10_000, 1 << 26), (10_000, 0)])
def test_lookup_without_broadcast_gives_the_same_rows(spark, hot_keys, hot_bytes):
    frame = settle(tuples(spark).withColumn("id", F.monotonically_increasing_id()), "rows")
    mapping = dense_keys(rank_tuples(frame, ["a", "b"]), ["a", "b"], "key")
    extra = spark.createDataFrame([("new", 1.0, -1)], "a string, b double, id bigint")
    rows = frame.unionByName(extra)

    def found(**limits):
        looked_up = lookup_key(rows, mapping, ["a", "b"], ["key"], count_column=COUNT, **limits)
        return sorted(map(repr, looked_up.select("id", "a", "b", "key").collect()))

    broadcast = found()
    assert len(broadcast) == rows.count()
    assert found(max_bytes=0, hot_keys=hot_keys, hot_bytes=hot_bytes) == broadcast


def test_stored_bytes_counts_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "s string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "s string")
    assert stored_bytes(long) - stored_bytes(short) == 9_990
    assert stored_bytes(short.limit(0)) == 0
    with pytest.raises(TypeError):
        stored_bytes(short.select(F.array("s").alias("nested")))


def test_keyed_replace_is_stable(spark):
    loads = spark.createDataFrame(
        [("d1", 1, 5.0, None), ("d1", 2, 1.0, "x"), ("d1", 2, 3.0, "a"), ("d2", 1, None, None)],
        "date string, loaded_at bigint, v double, w string",
    )
    wanted = {("d1", 2, 3.0, "a"), ("d2", 1, None, None)}
    assert set(map(tuple, keyed_replace(loads).collect())) == wanted
    assert set(map(tuple, keyed_replace(loads.repartition(4).orderBy(F.rand(3))).collect())) == wanted


def test_latest_and_first_rows(spark):
    log = spark.createDataFrame([(i, i // 2) for i in range(300)], "id bigint, at bigint")
    assert [r["id"] for r in latest_rows(log, "at", "id").collect()] == list(range(299, 199, -1))
    assert [r["id"] for r in first_rows(log.orderBy(F.desc("id")), "id").collect()] == [0, 1, 2, 3, 4]


def _integrated(spark):
    """Events whose keys hold nulls and odd flags, over two days."""
    schema = (
        "accident_id bigint, accident_date date, num_people_involved bigint, num_deaths bigint,"
        "num_vehicles_involved bigint, num_injuries bigint, region string, municipality string, settlement string,"
        "x_coordinate double, y_coordinate double, accident_type string, accident_detail string,"
        "drunk_driver_involved double"
    )
    day = date(2020, 1, 5)
    data = [
        (1, day, 1, 0, 1, 0, "r", "m", "s", 1.0, 2.0, "t", "d", 1.0),
        (1, day, 1, 0, 1, 0, "r", "m", "s", 1.0, 2.0, "t", "d", 1.0),
        (1, day, 1, 0, 1, 0, "r", "m", "s", None, 2.0, "t", "d", 1.0),
        (1, day, 1, 0, 1, 0, "r", None, "s", None, 2.0, "t", "d", 1.0),
        (2, day, 1, 0, 1, 0, "r", "m", "s", 1.0, 2.0, "t", "d", 2.0),
        (2, day, 1, 0, 1, 0, "r", "m", "s", 1.0, 2.0, "t", "d", 3.0),
        (2, day, 1, 0, 1, 0, "r", "m", "s", 1.0, 2.0, "t", "d", None),
        (3, date(2020, 1, 6), 1, 0, 1, 0, "r", "m", "s", 1.0, 2.0, "t", "d", 0.0),
    ]
    return settle(spark.createDataFrame(data, schema), "events")


@pytest.mark.parametrize("max_bytes", [0, 1 << 26])
def test_null_keys_stay_distinct_events(spark, max_bytes):
    events = _integrated(spark)
    series = spark.createDataFrame([(date(2020, 1, 5),), (date(2020, 1, 7),)], "weather_date date")
    found = fact(events, series, max_bytes=max_bytes)
    keys = found.select("accident_id", "date_key", "location_key", "accident_type_key", "weather_key").collect()
    # Two events differ only in which part of the place is missing, three only
    # in a flag that is neither 0 nor 1: none of them may collapse.
    assert sorted(map(repr, map(tuple, keys))) == sorted(
        map(
            repr,
            [
                (1, 1, 1, 2, 1),
                (1, 1, None, 2, 1),
                (1, 1, None, 2, 1),
                (2, 1, 1, None, 1),
                (2, 1, 1, None, 1),
                (2, 1, 1, None, 1),
                (3, 2, 1, 1, None),
            ],
        )
    )


def test_staging_takes_other_names(spark):
    frame = spark.createDataFrame([(1, 2)], "`id (x)` bigint, day bigint")
    assert stage_events(frame, {"id (x)": "event"}).columns == ["event"]
    assert stage_series(frame, {"day": "d"}).columns == ["d"]
