"""Orders and line items in the shape of events and a daily series.

Orders play the events and shipping days the series, so every operator can
run on the order tables at any size. All measures are whole numbers, which
makes sums and means exact in any order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.operators.series import integrate
from daymart.operators.scratch import settle
from daymart.schemas import (
    ALLOWED_REGIONS,
    CASE_NUMBER,
    DEATHS,
    DETAIL,
    DRUNK_DRIVER,
    EASTING,
    EVENT_TIME,
    FLAG_COLUMNS,
    INJURIES,
    MUNICIPALITY,
    NORTHING,
    PEOPLE,
    REGION,
    SERIES,
    SERIES_ARRAYS,
    SETTLEMENT,
    TYPE,
    VEHICLES,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _items_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures per order; an order's lines collapse before they shuffle."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").cast("bigint").alias(PEOPLE),
            F.count(F.lit(1)).alias(VEHICLES),
            F.sum("l_linenumber").cast("bigint").alias(INJURIES),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("bigint").alias(DEATHS),
        )
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the names of their nation and region.

    Nations are broadcast, as stored customers may look the smaller of the two.
    """
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return customer.select(
        "c_custkey",
        F.col("r_name").alias(REGION),
        F.col("n_name").alias(MUNICIPALITY),
        F.col("c_mktsegment").alias(SETTLEMENT),
        F.col("c_acctbal").alias(NORTHING),
        F.col("c_custkey").cast("double").alias(EASTING),
    )


def order_events(spark: SparkSession, sf_dir: str, located: bool = True) -> DataFrame:
    """One event per order; without a place when no report asks for it.

    Orders meet their items first and take the wide place columns last, so
    only numbers shuffle. One side of either join has one row per key: a
    customer with very many orders makes a long run of the other side only,
    which adaptive execution splits. Orders are merged with their items: by the
    size of their file they may look small enough to be gathered by the driver.
    """
    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(CASE_NUMBER),
        F.col("o_orderdate").cast("date").alias(EVENT_TIME),
        F.col("o_orderpriority").alias(TYPE),
        status.alias(DETAIL),
        F.when(status == "F", 1.0).when(status == "O", 0.0).alias(DRUNK_DRIVER),
        "o_custkey",
    )
    items = _items_per_order(spark, sf_dir)
    events = orders.join(items.hint("merge"), F.col(CASE_NUMBER) == F.col("l_orderkey")).drop("l_orderkey")
    if located:
        events = events.join(_places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    return events.drop("o_custkey")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per shipping day; the columns of the weather series."""
    days = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("quantity"),
            F.sum("l_linenumber").cast("bigint").alias("numbers"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    low = F.col("quantity") % 50 - 25
    wet = F.col("numbers") % 45
    values: dict[str, Column] = {
        "temperature_max": low + F.col("lines") % 10,
        "temperature_min": low,
        "precipitation_sum": wet,
        "snowfall_sum": F.when(low < 0, wet).otherwise(0),
        "rain_sum": F.when(low < 0, 0).otherwise(wet),
    }
    return days.select("date", *(value.cast("double").alias(name) for name, value in values.items()))


def stored_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series as a stored table, as the join wants it."""
    return settle(daily_series(spark, sf_dir), "daily")


def integrated_orders(spark: SparkSession, sf_dir: str, located: bool = True) -> DataFrame:
    return integrate(order_events(spark, sf_dir, located), stored_series(spark, sf_dir))


def stored_integrated(spark: SparkSession, sf_dir: str, located: bool = True) -> DataFrame:
    """The integrated table, stored: the models scan it several times."""
    return settle(integrated_orders(spark, sf_dir, located), "integrated")


def on_the_map(integrated: DataFrame) -> DataFrame:
    """Coordinates stretched into the national grid's range."""
    return integrated.withColumns(
        {
            NORTHING: F.col(NORTHING) * 20 + 6_375_000,
            EASTING: F.pmod(F.col(EASTING), F.lit(300_000.0)) + 400_000,
        }
    )


def raw_order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as unclean text records: some break a cleaning rule each."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    regions = F.array(*map(F.lit, [*ALLOWED_REGIONS, "Tallinn"]))
    texts = {
        CASE_NUMBER: F.when(key % 11 == 0, F.concat(F.lit("X"), key)).otherwise(key.cast("string")),
        EVENT_TIME: F.substring(F.col("o_orderdate").cast("string"), 1, 16),
        PEOPLE: F.when(key % 13 == 0, "NA").otherwise((key % 9).cast("string")),
        DEATHS: (key % 2).cast("string"),
        VEHICLES: (key % 4).cast("string"),
        INJURIES: (key % 5).cast("string"),
        REGION: F.get(regions, (customer % 16).cast("int")),
        MUNICIPALITY: F.col("o_orderpriority"),
        SETTLEMENT: F.when(F.col("o_orderstatus") == "F", "JAH").when(F.col("o_orderstatus") == "O", "EI").otherwise("jah"),
        TYPE: F.col("o_orderpriority"),
        DETAIL: F.when(key % 5 == 0, F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(' "a"; b,\n c '))).otherwise(
            F.col("o_orderstatus")
        ),
        **{name: (key % 2).cast("string") for name in FLAG_COLUMNS},
        NORTHING: F.when(key % 17 == 0, "").otherwise((customer * 10).cast("string")),
        EASTING: customer.cast("string"),
    }
    return table(spark, sf_dir, "orders").select(*(text.alias(name) for name, text in texts.items()))


def series_payloads(series: DataFrame) -> DataFrame:
    """The series as JSON text of parallel arrays, one payload per month.

    A month holds at most 31 days of a keyed series.
    """
    month = F.trunc("date", "MM").alias("month")
    days = series.groupBy(month).agg(F.sort_array(F.collect_list(F.struct(*SERIES.names))).alias("days"))

    def array_of(name: str) -> Column:
        values = F.transform("days", lambda day: day[name])
        return values.cast("array<string>") if name == "date" else values

    arrays = F.struct(*(array_of(new).alias(old) for old, new in SERIES_ARRAYS.items()))
    return days.select(F.to_json(F.struct(arrays.alias("daily"))).alias("payload"))
