"""Quoted files that split, and salts that a second run repeats."""

import random

import pytest
from pyspark.sql import functions as F

from daymart.operators import series as series_module
from daymart.operators.lookup import lookup_key
from daymart.operators.scratch import settle
from daymart.sources import read_raw_events


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_large_file_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path, small_splits, end):
    draw = random.Random(7)
    # Fields that are longer than a split, breaks at either end, doubled quotes and separators.
    bodies = ["plain", "two\nlines", '"\n', 'a ""; b\n\nc', "", "x;\n;y", "\n", "z" * 9000 + "\n" + "y" * 9000]
    lines = ["id;body;tail"]
    for k in range(900):
        lines.append(f"{k};{quoted(draw.choice(bodies))};{draw.choice(['t', quoted('t'), ''])}")
    (tmp_path / "large.csv").write_text(end.join(lines) + end, newline="")
    (tmp_path / "plain.csv").write_text("id;body;tail\n9001;no quotes;1\n\n9002;none;\n")
    split, whole = read_raw_events(spark, str(tmp_path)), read_raw_events(spark, str(tmp_path), multi_line=True)
    assert split.columns == whole.columns
    assert rows_of(split) == rows_of(whole)
    assert split.count() == 902
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_quotes_that_do_not_pair_fail(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a;b\n1;"open\n2;3\n')
    with pytest.raises(Exception, match="quotes do not pair"):
        read_raw_events(spark, str(tmp_path)).collect()


def test_salts_do_not_depend_on_places(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    mapping = settle(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), (F.max("id") * 2).alias("v")), "mapping")
    found = lookup_key(rows, mapping, ["k"], ["v"], count_column="n", max_bytes=0, hot_keys=10)
    assert "monotonically" not in found._jdf.queryExecution().toString()
    assert {(r["k"], r["v"]) for r in found.collect()} == {(r["k"], r["v"]) for r in mapping.collect()}
    days = spark.range(40).select(F.expr("date_add(date'2024-01-01', cast(id % 4 as int))").alias(series_module.EVENT_TIME), "id")
    series = settle(
        spark.range(4).select(
            F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"),
            *(F.col("id").cast("double").alias(c) for c in series_module.SERIES_VALUES),
        ),
        "series",
    )
    joined = series_module.integrate(days, series, max_bytes=0)
    assert "monotonically" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 40
