"""Known results for the ten fixture rows."""

import copy
from datetime import date, datetime

import fixture_rows as fx
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daymart.functions import to_wgs84
from daymart.operators import clean_events, integrate, settle, unzip_daily, validate_events, within_days
from daymart.plans import (
    build_star,
    density_grid,
    dim_accident_type,
    dim_location,
    dim_time,
    dim_weather,
    fact_wide,
    involved_by_precipitation,
    map_points,
    monthly_trend,
    monthly_trend_joined,
    severity_by_temperature,
    stage_events,
    stage_series,
)
from daymart.schemas import CASE_NUMBER, CLEAN_EVENTS, EASTING, EVENT_TIME, KEPT_COLUMNS, NORTHING, SERIES_VALUES
from daymart.sources import (
    read_clean_events,
    read_raw_events,
    read_series,
    read_series_payload,
    save_series,
    write_csv,
)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("fixture")
    fx.write_raw_csv(path / "raw.csv")
    fx.write_payload(path / "payload.json")
    return path


@pytest.fixture(scope="module")
def cleaned(spark, folder):
    raw = read_raw_events(spark, str(folder / "raw.csv"))
    return validate_events(clean_events(raw, fx.TIME_FORMAT))


@pytest.fixture(scope="module")
def series(spark, folder):
    return settle(unzip_daily(read_series_payload(spark, str(folder / "payload.json"))), "fixture-series")


@pytest.fixture(scope="module")
def integrated(cleaned, series):
    return settle(integrate(cleaned, series), "fixture-integrated")


def test_cleaning_keeps_six_rows(cleaned):
    assert cleaned.columns == KEPT_COLUMNS
    assert len(KEPT_COLUMNS) == 30
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in CLEAN_EVENTS]
    assert sorted(r[0] for r in rows(cleaned, CASE_NUMBER)) == [1, 1, 2, 7, 8, 9]


def test_time_keeps_its_day(cleaned):
    late = cleaned.filter(F.col(CASE_NUMBER) == 2)
    assert rows(late, EVENT_TIME) == [(datetime(2020, 1, 5, 23, 59),)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("column, text", [(EVENT_TIME, "yesterday"), (NORTHING, "north"), ("Isikuid", "two")])
def test_bad_text_in_a_kept_row_fails(spark, tmp_path, ansi, column, text):
    fx.write_raw_csv(tmp_path / "raw.csv", **{column: text})
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bad = clean_events(read_raw_events(spark, str(tmp_path / "raw.csv")), fx.TIME_FORMAT)
        with pytest.raises(Exception, match=text):
            bad.collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_missing_column_fails(spark, folder):
    raw = read_raw_events(spark, str(folder / "raw.csv")).drop(NORTHING)
    with pytest.raises(AnalysisException):
        clean_events(raw, fx.TIME_FORMAT)


def test_files_with_another_header_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("one;two\n1;2\n")
    (tmp_path / "b.csv").write_text("two;one\n2;1\n")
    with pytest.raises(Exception, match="header"):
        read_raw_events(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("text", ["NA", "null", "#N/A", "NaN"])
def test_null_spellings_drop_the_row(spark, tmp_path, text):
    fx.write_raw_csv(tmp_path / "raw.csv", **{NORTHING: text})
    assert clean_events(read_raw_events(spark, str(tmp_path / "raw.csv")), fx.TIME_FORMAT).isEmpty()


def test_clean_csv_round_trip(spark, cleaned, tmp_path):
    path = str(tmp_path / "clean")
    write_csv(cleaned, path)
    first_file = next((tmp_path / "clean").glob("*.csv")).read_text(encoding="utf-8").splitlines()
    assert first_file[0].startswith("Juhtumi nr;Toimumisaeg;Isikuid;")
    assert "2020-01-05 08:10:00" in first_file[1]
    assert sorted(rows(read_clean_events(spark, path))) == sorted(rows(cleaned))


def test_series_unzips(series):
    assert rows(series.orderBy("date"))[0] == (date(2020, 1, 5), 2.0, -10.0, 12.0, 1.0, 11.0)
    assert series.count() == 4


def _payload(**changes):
    payload = copy.deepcopy(fx.PAYLOAD)
    payload["daily"].update(changes)
    return payload


def test_null_in_an_array_stays_null(spark, tmp_path):
    fx.write_payload(tmp_path / "p.json", _payload(rain_sum=[None, 0.0, 31.0, 5.0]))
    series = unzip_daily(read_series_payload(spark, str(tmp_path / "p.json")))
    assert rows(series.orderBy("date"), "rain_sum")[0] == (None,)


@pytest.mark.parametrize(
    "payload, message",
    [
        (_payload(rain_sum=[1.0, 2.0]), "differ in length"),
        (_payload(rain_sum=None), "missing"),
        ({"reason": "no data"}, "no daily data"),
    ],
)
def test_broken_payload_fails(spark, tmp_path, payload, message):
    fx.write_payload(tmp_path / "p.json", payload)
    with pytest.raises(Exception, match=message):
        unzip_daily(read_series_payload(spark, str(tmp_path / "p.json"))).collect()


def test_series_range_includes_both_ends(series):
    assert within_days(series, "2020-02-10", "2020-02-11").count() == 2
    assert within_days(series).count() == 4


def test_loading_twice(spark, cleaned, series, tmp_path):
    kept, appended = str(tmp_path / "kept"), str(tmp_path / "appended")
    for day in (1, 2):
        save_series(series, kept, datetime(2024, 1, day))
        save_series(series, appended, datetime(2024, 1, day), mode="append")
    assert sorted(rows(read_series(spark, kept))) == sorted(rows(series))
    assert read_series(spark, appended).count() == 8
    assert integrate(cleaned, read_series(spark, appended)).count() == 10


def test_a_later_load_wins(spark, series, tmp_path):
    path = str(tmp_path / "series")
    save_series(series, path, datetime(2024, 1, 2))
    save_series(series.withColumn("rain_sum", F.lit(-1.0)), path, datetime(2024, 1, 1))
    assert sorted(rows(read_series(spark, path))) == sorted(rows(series))
    save_series(series.limit(1).withColumn("rain_sum", F.lit(-1.0)), path, datetime(2024, 1, 3))
    assert sorted(r[0] for r in rows(read_series(spark, path), "rain_sum")).count(-1.0) == 1


def test_integrated(integrated):
    assert integrated.columns == [*KEPT_COLUMNS, "date", *SERIES_VALUES]
    assert len(integrated.columns) == 36
    assert sorted(r[0] for r in rows(integrated, CASE_NUMBER)) == [1, 1, 2, 8, 9]


DATES = [
    (1, date(2020, 1, 5), 2020, 1, 5, 0),
    (2, date(2020, 2, 10), 2020, 2, 10, 1),
    (3, date(2020, 2, 11), 2020, 2, 11, 2),
]
HARJU = ("Harju maakond", "Tallinn", "JAH", 6588900.0, 542700.0)
TARTU = ("Tartu maakond", "Tartu linn", "EI", 6474000.0, 659000.0)
CRASH = ("Kokkupõrge", "Külgkokkupõrge", False)
LEFT_ROAD = ("Ühesõidukiõnnetus", "Teelt väljasõit", True)
FACTS = [
    (1, 1, 1, 1, 1, 2, 0, 2, 1),
    (2, 1, 1, 1, 1, 3, 1, 1, 2),
    (8, 2, 2, 2, 2, 1, 0, 1, 0),
    (9, 3, 2, 1, 3, 4, 0, 2, 3),
]


def test_conformed_star(integrated):
    star = build_star(integrated)
    assert rows(star.dim_date) == DATES
    assert star.dim_date.dtypes == [
        ("date_key", "bigint"),
        ("full_date", "date"),
        *((name, "bigint") for name in ("year", "month", "day", "day_of_week")),
    ]
    assert rows(dim_time(star.dim_date)) == [(d[1], d[2]) for d in DATES]
    assert sorted(rows(star.dim_location)) == [(1, *HARJU), (2, *TARTU)]
    assert sorted(rows(star.dim_accident_type)) == [(1, *CRASH), (2, *LEFT_ROAD)]
    assert [r[:2] for r in sorted(rows(star.dim_weather))] == [(i + 1, d[1]) for i, d in enumerate(DATES)]
    assert sorted(rows(star.fact)) == FACTS
    wide = fact_wide(star.fact, star.dim_weather)
    assert sorted(rows(wide, "accident_id", "max_temperature")) == [(1, 2.0), (2, 2.0), (8, -5.0), (9, 6.0)]


def test_the_wide_fact_refuses_keys_that_are_not_its_own(integrated):
    star = build_star(integrated, "as_written")
    with pytest.raises(ValueError, match="conformed"):
        fact_wide(star.fact, star.dim_weather)


def test_as_written_star(integrated):
    star = build_star(integrated, "as_written")
    assert sorted(rows(star.dim_location)) == [(k, *(HARJU if k <= 3 else TARTU)) for k in range(1, 6)]
    assert sorted(rows(star.dim_accident_type)) == [(k, *(CRASH if k <= 4 else LEFT_ROAD)) for k in range(1, 6)]
    days = {1: 5, 2: 5, 3: 5}
    assert [r[1] for r in sorted(rows(star.dim_weather))] == [date(2020, 1, days[k]) for k in (1, 2, 3)] + [
        date(2020, 2, 10),
        date(2020, 2, 11),
    ]
    assert sorted(rows(star.fact)) == FACTS
    # The trap: key 2 of the fact is another place in the as-written dimension.
    assert rows(star.dim_location.filter("location_key = 2"), "region") == [("Harju maakond",)]


def test_unknown_mode_fails(integrated):
    for build in (dim_location, dim_accident_type):
        with pytest.raises(ValueError):
            build(stage_events(integrated), "other")


def test_two_rows_for_a_day_fail_when_conformed(integrated):
    series = stage_series(integrated)
    other = series.withColumn("rainfall", F.col("rainfall") + 1)
    with pytest.raises(Exception, match="different rows for 2020"):
        dim_weather(series.union(other)).collect()
    assert dim_weather(series.union(other), "as_written").count() == 10


def test_severity(integrated):
    assert rows(severity_by_temperature(integrated)) == [
        (0, "< -10°C", 1.0, 0.25),
        (1, "-10°C to 0°C", None, None),
        (2, "0°C to 10°C", 3.0, 0.0),
        (3, "10°C to 20°C", None, None),
        (4, "> 20°C", None, None),
    ]


def test_involved(integrated):
    assert rows(involved_by_precipitation(integrated)) == [
        (0, "0-10 mm", 0, 0),
        (1, "10-20 mm", 5, 7),
        (2, "20-30 mm", 0, 0),
        (3, "> 30 mm", 2, 4),
    ]


def test_monthly_trend(integrated):
    wanted = [
        (date(2020, 1, 1), 7, 36.0, -10.0, 2.0, -4.0),
        (date(2020, 2, 1), 5, 31.0, -6.0, 0.5, -2.75),
    ]
    assert rows(monthly_trend(integrated).orderBy("YearMonth")) == wanted
    assert rows(monthly_trend_joined(integrated).orderBy("YearMonth")) == wanted
    by_day = monthly_trend(integrated, weighting="day").orderBy("YearMonth")
    assert rows(by_day, "people", "precipitation") == [(7, 12.0), (5, 31.0)]


def test_sum_of_nulls_is_zero(integrated):
    dry = integrated.withColumn("precipitation_sum", F.lit(None).cast("double"))
    assert {r[0] for r in rows(monthly_trend(dry), "precipitation")} == {0.0}


def test_projection(spark):
    # Known positions: longitude, latitude.
    points = spark.createDataFrame([(6588900.0, 542700.0), (6474000.0, 659000.0)], ["x", "y"])
    longitude, latitude = to_wgs84(F.col("y"), F.col("x"))
    found = rows(points.select(F.round(longitude, 7), F.round(latitude, 7)))
    assert found == [(24.7524564, 59.4357832), (26.7184103, 58.3774802)]


def test_map_layers(integrated):
    points = map_points(integrated)
    assert points.columns == ["Latitude", "Longitude", "Precipitation (mm)", "Injured", "Date"]
    assert points.count() == 5
    cells = sorted(rows(density_grid(integrated, 10_000.0), "cell_x", "cell_y", "weight", "events"))
    assert cells == [(54, 658, 7, 3), (65, 647, 5, 2)]
    assert density_grid(integrated, 10_000.0, easting=EASTING, northing=NORTHING).columns[-2:] == ["Longitude", "Latitude"]
