"""What the physical plans must and must not hold."""

import re
from contextlib import contextmanager

from pyspark.sql import functions as F

import __spark_entry__ as driver
from daymart.operators import dense_keys, integrate, lookup_key, rank_tuples, settle
from daymart.operators.keys import COUNT
from daymart.plans import latest_rows, monthly_trend, severity_by_temperature
from daymart.plans.order_events import integrated_orders, order_events, stored_integrated, table
from daymart.plans.reports import weight_around
from daymart.plans.star import fact, location_mapping, stage_events, stage_series
from daymart.schemas import CASE_NUMBER, EVENT_TIME

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in values:
            spark.conf.unset(name)


def plan(df):
    """The plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan adaptive execution ended with."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def exchanges(text):
    return len(re.findall(r"\bExchange \w+", text))


def test_the_stored_series_is_broadcast(spark):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(integrated_orders(spark, SF_DIR, located=False).select(CASE_NUMBER, "rain_sum"))
    assert re.search(r"BroadcastHashJoin \[Toimumisaeg#\d+\], \[date#\d+\], Inner, BuildRight", text)


def test_reports_scan_only_their_columns_and_shuffle_once(spark):
    stored = stored_integrated(spark, SF_DIR, located=False)
    assert exchanges(plan(monthly_trend(stored))) == 1
    # One exchange of partial sums and none for the order of the bands.
    severity = plan(severity_by_temperature(stored))
    assert exchanges(severity) == 1
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", severity).group(1)
    columns = {name.rsplit("#", 1)[0] for name in scanned.split(",")}
    assert columns == {"temperature_min", "Vigastatuid", "Hukkunuid"}


def test_series_range_reaches_the_scan(spark):
    text = plan(driver.queries()["series_range"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date," in text


def test_stored_years_are_pruned(spark):
    text = plan(driver.queries()["partitioned_table"](spark, SF_DIR).filter(F.col("year").isin(1995, 1996)))
    assert re.search(r"PartitionFilters: \[[^\]]*year", text)


def test_log_is_not_sorted_whole(spark):
    text = plan(latest_rows(table(spark, SF_DIR, "events"), "ts", "event_id"))
    assert "TakeOrderedAndProject(limit=100" in text
    assert "Exchange rangepartitioning" not in text


def test_only_bounded_tables_meet_in_one_task(spark):
    integrated = stored_integrated(spark, SF_DIR)
    events = stage_events(integrated)
    mapping = dense_keys(rank_tuples(events, ["region", "x_coordinate"]), ["region", "x_coordinate"], "key")
    # The one window without partitions runs over the partition offsets.
    text = plan(mapping)
    assert text.count("Exchange SinglePartition") == 1
    assert re.search(r"Window \[sum\(_amount#", text)
    assert not re.search(r"Window \[row_number", text)


def test_fact_shuffles_events_once_and_narrow(spark):
    integrated = stored_integrated(spark, SF_DIR)
    text = plan(fact(stage_events(integrated), stage_series(integrated)))
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "accident_id" in line]
    assert len(wide) == 1
    assert "region" not in wide[0] and "accident_detail#" not in wide[0]
    assert "SortMergeJoin" not in text


def test_hot_keys_are_spread(spark):
    """A third of the rows have one key: a broadcast answers them, and they do not meet in a task."""
    rows = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    rows = settle(rows, "skewed")
    mapping = settle(dense_keys(rank_tuples(rows, ["k"]), ["k"], "key"), "mapping")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        found = lookup_key(rows, mapping, ["k"], ["key"], count_column=COUNT, max_bytes=0, hot_keys=100)
        text = final_plan(found)
        assert found.filter("key IS NULL").isEmpty() and found.count() == 9_000
    assert "SortMergeJoin" in text and "_salt" in text
    # One pass over the rows, whatever the key.
    assert len(re.findall(r"FileScan parquet \[id#", text)) == 1


def _days(spark, n):
    return spark.range(n).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"))


def test_appended_loads_are_counted_and_broadcast(spark):
    """Many equal loads of the series: events do not move, and each is repeated per load."""
    series = settle(_days(spark, 2_000).crossJoin(spark.range(30)).select("date"), "appended")
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2_000).cast("int"))
    events = settle(spark.range(20_000).select(F.col("id").alias(CASE_NUMBER), days.alias(EVENT_TIME)), "events")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        joined = integrate(events, series, max_bytes=200_000)
        text = final_plan(joined)
        assert joined.count() == 20_000 * 30
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_no_event_moves_by_its_day_alone(spark):
    """Every day is large and there are more days than partitions."""
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    events = settle(spark.range(40_000).select(F.col("id").alias(CASE_NUMBER), days.alias(EVENT_TIME)).repartition(4), "events")
    series = settle(_days(spark, 40), "days")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        joined = integrate(events, series, max_bytes=0)
        text = final_plan(joined)
        assert joined.count() == 40_000
    assert "SortMergeJoin" in text
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all("_salt" in line or "_share" in line for line in moved)


def test_location_mapping_is_over_stored_tuples(spark):
    text = plan(location_mapping(stage_events(stored_integrated(spark, SF_DIR))))
    # Only the offsets of the parts are worked out; the tuples stay where they are.
    assert re.search(r"FileScan parquet", text)
    assert all(by.startswith("_part#") for by in re.findall(r"Exchange hashpartitioning\(([^)]*)", text))


def test_places_repeated_for_their_cells_are_not_broadcast(spark):
    """Stored places are small, their copies for tens of cells are not: the driver must not gather them."""
    points = settle(spark.range(400).selectExpr("double(id % 20) AS e", "double(id DIV 20) AS n", "id AS w"), "points")
    around = weight_around(points, 2.0, "w", "e", "n")
    assert "Broadcast" not in plan(around)
    found = {(r["x"], r["y"]): (r["weight"], r["events"]) for r in around.collect()}
    assert "Broadcast" not in plan(around)
    steps = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if a * a + b * b <= 4]
    for x in range(20):
        for y in range(20):
            near = [20 * (y + b) + x + a for a, b in steps if 0 <= x + a < 20 and 0 <= y + b < 20]
            assert found.pop((x, y)) == (sum(near), len(near))
    assert not found


def test_nations_are_broadcast_and_neither_customers_nor_orders(spark, tmp_path):
    """Tables whose files are small beside their rows, as those of repeated values are."""
    for name in ("nation", "region", "orders", "lineitem"):
        table(spark, SF_DIR, name).write.parquet(f"{tmp_path}/{name}.parquet")
    customer = table(spark, SF_DIR, "customer").withColumn("c_acctbal", F.lit(0.0))
    customer.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    events = order_events(spark, str(tmp_path))
    assert re.search(r"SortMergeJoin \[Juhtumi nr#\d+L\], \[l_orderkey#\d+L\], Inner", plan(events))
    text = final_plan(events)
    assert re.search(r"SortMergeJoin \[Juhtumi nr#\d+L\], \[l_orderkey#\d+L\], Inner", text)
    assert re.search(r"BroadcastHashJoin \[c_nationkey#\d+\], \[n_nationkey#\d+\], Inner, BuildRight", text)
    assert events.count() == order_events(spark, SF_DIR).count()
