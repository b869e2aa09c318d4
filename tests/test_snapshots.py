"""Snapshots, digests of exports, and sums around places."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from daymart.plans import reports
from daymart.sources import (
    append_snapshot,
    drop_snapshots,
    export_parquet,
    read_series,
    read_snapshot,
    replace_snapshot,
    save_series,
    snapshot_versions,
    snapshots,
    table_digest,
    writers,
)
from daymart.schemas import SERIES_VALUES


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_reader_keeps_its_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_snapshot(spark.range(3), path) == 1
    pinned = read_snapshot(spark, path)
    assert append_snapshot(spark.range(3, 5), path) == 2
    assert replace_snapshot(spark.range(9, 10), path) == 3
    assert (ids(pinned), ids(read_snapshot(spark, path, 2)), ids(read_snapshot(spark, path))) == ([0, 1, 2], [0, 1, 2, 3, 4], [9])
    drop_snapshots(spark, path)
    assert snapshot_versions(spark, path) == [3] and ids(read_snapshot(spark, path)) == [9]
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path, 1)
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, str(tmp_path / "none"))


def test_a_plain_folder_is_the_first_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    assert append_snapshot(spark.range(2, 4), path) == 1
    assert ids(read_snapshot(spark, path)) == [0, 1, 2, 3]
    assert ids(spark.read.parquet(path)) == [0, 1]


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_snapshot(spark.range(3), path)
    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "_create_if_absent", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            append_snapshot(spark.range(3, 5), path)
    assert snapshot_versions(spark, path) == [1] and ids(read_snapshot(spark, path)) == [0, 1, 2]
    drop_snapshots(spark, path)
    assert ids(read_snapshot(spark, path)) == [0, 1, 2]


def test_no_load_is_lost_when_writers_meet(spark, tmp_path):
    path = str(tmp_path / "t")
    loads = [threading.Thread(target=append_snapshot, args=(spark.range(k, k + 1), path)) for k in range(6)]
    for load in loads:
        load.start()
    for load in loads:
        load.join()
    assert ids(read_snapshot(spark, path)) == list(range(6))
    assert snapshot_versions(spark, path) == list(range(1, 7))


def test_a_replacing_load_starts_again_from_a_faster_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "series")
    days = spark.range(3).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"), *(F.lit(1.0).alias(c) for c in SERIES_VALUES))
    save_series(days, path, datetime(2024, 1, 1))
    merge, met = writers.keyed_replace, []

    def slow(loads):
        if not met:
            met.append(1)
            save_series(days.limit(0).union(days.selectExpr("date_add(date, 10) as date", *SERIES_VALUES)), path, datetime(2024, 1, 2))
        return merge(loads)

    monkeypatch.setattr(writers, "keyed_replace", slow)
    save_series(days.withColumn("rain_sum", F.lit(2.0)), path, datetime(2024, 1, 3))
    kept = sorted((r["date"].day, r["rain_sum"]) for r in read_series(spark, path).collect())
    assert kept == [(1, 2.0), (2, 2.0), (3, 2.0), (11, 1.0), (12, 1.0), (13, 1.0)]


def test_digests_tell_values_and_places(spark):
    schema = "a int, b int, c array<int>, d map<string,int>"
    base = [(1, None, [1, None], {"x": 1, "y": 2}), (2, 3, None, None)]
    digest = table_digest(spark.createDataFrame(base, schema))
    assert table_digest(spark.createDataFrame(base[::-1], schema)) == digest
    assert table_digest(spark.createDataFrame([(1, None, [1, None], {"y": 2, "x": 1}), base[1]], schema)) == digest
    others = [(None, 1, [1, None], {"x": 1, "y": 2}), (1, None, [None, 1], {"x": 1, "y": 2}), (1, None, [1], {"x": 1, "y": 2}), (1, None, [1, None], {"x": 2, "y": 1})]
    for other in others:
        assert table_digest(spark.createDataFrame([other, base[1]], schema)) != digest
    assert table_digest(spark.createDataFrame([], schema)) == (0, 0)


def test_an_export_that_differs_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "table_digest", lambda _: (10, 0))
    with pytest.raises(RuntimeError, match="main_n"):
        export_parquet({("main", "main_n"): spark.range(10)}, str(tmp_path))


def test_sums_around_places_are_those_of_all_pairs(spark):
    # Places on the rim (3-4-5), on cell borders, below zero, and one that is very often met.
    points = [(0.0, 0.0, 1), (3.0, 4.0, 2), (5.0, 0.0, 4), (-5.0, 0.0, 8), (5.1, 0.0, 16), (0.0, -2.5, 32), (100.0, 7.0, 64)]
    points += [(0.3, 0.4, 1)] * 500 + [(None, 1.0, 9), (1.0, None, 9), (2.5, 2.5, None)]
    table = spark.createDataFrame(points, "e double, n double, w long")
    found = {(r["x"], r["y"]): (r["weight"], r["events"]) for r in reports.weight_around(table, 5.0, "w", "e", "n").collect()}
    known = [p for p in points if p[0] is not None and p[1] is not None]
    for x, y in {(p[0], p[1]) for p in known}:
        near = [p for p in known if (p[0] - x) ** 2 + (p[1] - y) ** 2 <= 25]
        assert found.pop((x, y)) == (sum(p[2] or 0 for p in near), len(near))
    assert not found
