"""Events in buckets of their location: the same fact, and no event moves again."""

import re

import pytest
from pyspark.sql import functions as F

from daymart.operators.colocate import PLACE, SPREAD, bucket_count, co_locate, place_text
from daymart.operators.scratch import settle
from daymart.plans.colocated import locate_events, located_fact, locations_of
from daymart.plans.order_events import stored_integrated
from daymart.plans.star import fact, stage_events, stage_series, type_mapping
from daymart.schemas import LOCATION_KEYS
from test_plans import settings

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def integrated(spark):
    """Orders, a third of them at one place, some places with nulls, some rows twice."""
    rows = stored_integrated(spark, SF_DIR)
    staged = stage_events(rows)
    third, some = F.col("accident_id") % 3 == 0, F.col("accident_id") % 7 == 1
    place = staged.orderBy("accident_id").first()
    at_one = {c: F.when(third, F.lit(place[c])).otherwise(F.col(c)) for c in LOCATION_KEYS}
    settlement = F.when(some & ~third, None).otherwise(F.col("settlement"))
    events = staged.withColumns(at_one).withColumn("settlement", settlement)
    return settle(events.union(events.filter("accident_id % 5 = 0")), "test"), stage_series(rows)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("hot_keys", [20_000, 4, 1])
def test_the_fact_is_the_same(spark, integrated, hot_keys):
    events, series = integrated
    located = locate_events(events, "located_test", hot_keys=hot_keys)
    found = located_fact(located, series, locations_of("located_test", located))
    wanted = fact(events, series)
    assert found.columns == wanted.columns
    assert rows_of(found) == rows_of(wanted)


def test_no_event_moves_after_it_is_located(spark, integrated):
    events, series = integrated
    located = locate_events(events, "located_plan", buckets=8)
    locations = locations_of("located_plan", located)
    types = settle(type_mapping(events), "types")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        result = located_fact(located, series, locations, types)
        result.collect()
        text = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin [_place" in text
    moved = re.findall(r"\bExchange (\w+\([^)]*\)?|SinglePartition)", text)
    # Days alone: summed ones, and their window, which the calendar bounds.
    assert all("full_date" in m or m == "SinglePartition" for m in moved), moved
    assert not any("accident_id" in m or PLACE in m for m in moved)


def test_a_hot_place_is_spread_and_equal_rows_meet(spark, integrated):
    events, _ = integrated
    located = locate_events(events, "located_hot", buckets=16, hot_keys=20)
    assert bucket_count(spark, "located_hot") == 16
    parts = located.groupBy(PLACE).agg(F.count_distinct(SPREAD).alias("parts"), F.count(F.lit(1)).alias("rows"))
    hottest = parts.orderBy(F.desc("rows")).first()
    assert hottest["rows"] > events.count() / 4 and hottest["parts"] > 100
    assert parts.filter("parts > 1").count() == 1
    in_file = located.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert in_file < 2.5 * events.count() / 16
    apart = located.groupBy("accident_id", *LOCATION_KEYS).agg(F.count_distinct(SPREAD).alias("n")).filter("n > 1")
    assert apart.isEmpty()


def test_places_are_told_apart(spark):
    rows = [("a", "b", 0.0), ("a", "b", -0.0), ("ab", "", 0.0), ("a", None, 0.0), ("a", "-", 0.0), (None, "a", None), ("1:a", "b", 1.5)]
    table = spark.createDataFrame(rows, "r string, s string, x double")
    texts = [r[0] for r in table.select(place_text(table, ["r", "s", "x"])).collect()]
    assert texts[0] == texts[1] and None not in texts and len(set(texts)) == 6
    with pytest.raises(TypeError, match="no text of its own"):
        place_text(table.withColumn("m", F.array("r")), ["m"])


def test_an_empty_table_is_located(spark, integrated):
    events, _ = integrated
    assert co_locate(events.limit(0), LOCATION_KEYS, ["accident_id"], "located_none").collect() == []
