"""Registered queries: each runs an operator over whole order tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.functions.days import lenient_day, timestamp_text
from daymart.functions.geo import to_wgs84
from daymart.operators.audit import audit_events, read_kept, read_rejected
from daymart.operators.clean import clean_events, validate_events
from daymart.operators.series import integrate, keyed_replace, unzip_daily, within_days
from daymart.operators.keys import COUNT, dense_keys, rank_tuples
from daymart.operators.scratch import scratch_path
from daymart.plans import reports, star
from daymart.plans.colocated import locate_events, located_fact, locations_of
from daymart.plans.given_tables import MOMENT, REAL, TABLES, TEXT, VECTOR
from daymart.plans.order_events import (
    daily_series,
    integrated_orders,
    on_the_map,
    order_events,
    raw_order_texts,
    series_payloads,
    stored_integrated,
    stored_series,
    table,
)
from daymart.schemas import (
    CASE_NUMBER,
    EASTING,
    EVENT_TIME,
    LOCATION_KEYS,
    NORTHING,
    PEOPLE,
    SERIES_PAYLOAD,
    STAGED_EVENT_COLUMNS,
)
from daymart.sources.infer import find_types, typed
from daymart.sources.readers import TEMPORARY, list_tables, read_clean_events, read_raw_events, read_series, read_table
from daymart.sources.snapshots import snapshot_versions
from daymart.sources.writers import export_name, export_parquet, publish_model, save_series, save_table, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm"
CELL_METRES = 10_000.0
AROUND_METRES = 2_000.0


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- Reports --------------------------------------------------------------


@query
def severity_by_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.severity_by_temperature(integrated_orders(spark, sf_dir, located=False))


@query
def involved_by_precipitation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.involved_by_precipitation(integrated_orders(spark, sf_dir, located=False))


@query
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _double_rain(reports.monthly_trend(integrated_orders(spark, sf_dir, located=False)))


@query
def monthly_trend_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    integrated = integrated_orders(spark, sf_dir, located=False)
    return _double_rain(reports.monthly_trend(integrated, weighting="day"))


@query
def monthly_trend_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events 20 days after their series day, so that the two months differ."""
    integrated = stored_integrated(spark, sf_dir, located=False)
    shifted = integrated.withColumn(EVENT_TIME, F.date_add(EVENT_TIME, 20))
    return _double_rain(reports.monthly_trend_joined(shifted))


def _double_rain(trend: DataFrame) -> DataFrame:
    return trend.withColumn("precipitation", F.col("precipitation").cast("double"))


@query
def count_by_region_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = reports.count_by_region_type(integrated_orders(spark, sf_dir))
    return counts.toDF("region", "accident_type", "total_accidents")


@query
def density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = reports.density_grid(on_the_map(integrated_orders(spark, sf_dir)), CELL_METRES)
    return _rounded(cells)


@query
def weight_around_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.weight_around(on_the_map(integrated_orders(spark, sf_dir)), AROUND_METRES)


@query
def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.map_points(on_the_map(integrated_orders(spark, sf_dir))))


@query
def crs_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = on_the_map(order_events(spark, sf_dir))
    longitude, latitude = to_wgs84(F.col(EASTING), F.col(NORTHING))
    points = events.select(F.col(CASE_NUMBER).alias("event_id"), longitude.alias("Longitude"), latitude.alias("Latitude"))
    return _rounded(points)


def _rounded(points: DataFrame) -> DataFrame:
    return points.withColumns({name: F.round(name, 7) for name in ("Longitude", "Latitude")})


@query
def latest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    newest = reports.latest_rows(events, "ts", "event_id")
    return newest.withColumn("ts", timestamp_text(F.col("ts")))


@query
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.first_rows(integrated_orders(spark, sf_dir, located=False), CASE_NUMBER)
    return rows.select(F.col(CASE_NUMBER).alias("accident_id"), F.col(EVENT_TIME).alias("accident_date"))


# --- Cleaning and integration ---------------------------------------------


@query
def clean_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_events(raw_order_texts(spark, sf_dir), RAW_TIME_FORMAT)
    return _shown(validate_events(cleaned))


def _shown(cleaned: DataFrame) -> DataFrame:
    staged = star.stage_events(cleaned)
    return staged.withColumn("accident_date", timestamp_text(F.col("accident_date")))


@query
def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the rules they break, one that breaks several under each, and those that break none."""
    raw, path = raw_order_texts(spark, sf_dir), scratch_path(spark, "audit")
    number = F.regexp_replace(CASE_NUMBER, "X", "").cast("bigint")
    raw = raw.withColumn(EASTING, F.when(number % 19 == 0, "12,5").otherwise(F.col(EASTING)))
    audit_events(raw, path, RAW_TIME_FORMAT)
    rejected = read_rejected(spark, path).select(F.explode("rules").alias("rule"))
    kept = _shown(read_kept(spark, path, RAW_TIME_FORMAT)).select(F.lit("none").alias("rule"))
    return rejected.unionByName(kept).groupBy("rule").agg(F.count(F.lit(1)).alias("events"))


def _order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text whose types and layouts nobody states."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    # The day of the month is never above 12, so day and month could be swapped.
    either = F.concat_ws("/", F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lpad((key % 11 + 1).cast("string"), 2, "0"), F.lit("1997"))
    clock = F.concat(F.date_format(day, "dd.MM.yyyy"), F.lit(" "), F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":30"))
    texts = {
        "key": key.cast("string"),
        "price": F.when(key % 7 == 0, "").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")),
        "code": F.lpad((key % 1000).cast("string"), 4, "0"),
        "flag": F.when(key % 2 == 0, "true").otherwise("False"),
        "day": F.date_format(day, "yyyy-MM-dd"),
        "moment": clock,
        "either": either,
        "mixed": F.when(key % 1000 == 1, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")),
        "nothing": F.when(key < 0, "x"),
    }
    return table(spark, sf_dir, "orders").select(*(text.alias(name) for name, text in texts.items()))


@query
def found_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type and layout of each column, and what an ambiguous one may be."""
    found = find_types(_order_texts(spark, sf_dir))
    return found.withColumn("candidates", F.array_join(F.array_sort("candidates"), ","))


@query
def typed_by_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read with the types found; the layout of the ambiguous column is stated."""
    path = scratch_path(spark, "untyped-csv")
    write_csv(_order_texts(spark, sf_dir), path)
    texts = read_raw_events(spark, path)
    rows = typed(texts, find_types(texts), {"either": "MM/dd/yyyy"})
    shown = rows.withColumn("moment", timestamp_text(F.col("moment")))
    return shown.select("key", F.round(F.col("price") * 100).cast("bigint").alias("cents"), "code", "flag", "day", "moment", "either", "mixed")


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text to CSV and back, cleaned, to CSV and back with types."""
    raw_path, clean_path = scratch_path(spark, "raw-csv"), scratch_path(spark, "clean-csv")
    write_csv(raw_order_texts(spark, sf_dir), raw_path)
    cleaned = validate_events(clean_events(read_raw_events(spark, raw_path), RAW_TIME_FORMAT))
    write_csv(cleaned, clean_path)
    return _shown(read_clean_events(spark, clean_path))


@query
def integrate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    integrated = integrated_orders(spark, sf_dir, located=False)
    return integrated.select(
        F.col(CASE_NUMBER).alias("event_id"),
        F.col(EVENT_TIME).alias("event_date"),
        F.col(PEOPLE).alias("people"),
        "date",
        "temperature_max",
        "temperature_min",
        "precipitation_sum",
        "snowfall_sum",
        "rain_sum",
    )


@query
def integrate_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series appended twice without a key: each event meets its day twice."""
    path = scratch_path(spark, "appended")
    series = daily_series(spark, sf_dir)
    for load in (1, 2):
        save_series(series, path, _load_time(load), mode="append")
    integrated = integrate(order_events(spark, sf_dir, located=False), read_series(spark, path))
    per_day = integrated.groupBy("date").agg(F.count(F.lit(1)).alias("events"), F.sum(PEOPLE).alias("people"))
    return per_day


def _load_time(load: int) -> datetime:
    return datetime(2024, 1, load)


@query
def keyed_replace_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load with changed values wins on the days it has."""
    series = daily_series(spark, sf_dir)
    later = series.filter(F.dayofmonth("date") > 15).withColumn("rain_sum", F.col("rain_sum") + 1)
    first = series.withColumn("loaded_at", F.lit(1))
    second = later.withColumn("loaded_at", F.lit(2))
    return keyed_replace(first.unionByName(second)).withColumn("loaded_at", F.col("loaded_at").cast("bigint"))


@query
def series_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history stored twice in replace mode: one row per day."""
    path = scratch_path(spark, "reloaded")
    series = stored_series(spark, sf_dir)
    for load in (1, 2):
        save_series(series, path, _load_time(load))
    return read_series(spark, path)


@query
def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series documents with an internal id, read without it."""
    path = scratch_path(spark, "documents")
    documents = daily_series(spark, sf_dir).withColumn("_id", F.date_format("date", "yyyyMMdd"))
    documents.write.json(path)
    return read_series(spark, path, "json")


@query
def series_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return within_days(stored_series(spark, sf_dir), "1994-01-01", "1996-12-31")


@query
def daily_array_unzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = series_payloads(daily_series(spark, sf_dir))
    parsed = payloads.select(F.from_json("payload", SERIES_PAYLOAD).alias("p")).select("p.daily")
    return unzip_daily(parsed)


@query
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k BIGINT")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


@query
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_events(spark, sf_dir, located=False)
    fields = {"event_id": CASE_NUMBER, "day": EVENT_TIME, "people": PEOPLE}
    record = F.to_json(F.struct(*(F.col(old).alias(new) for new, old in fields.items())))
    return rows.select(F.col(CASE_NUMBER).alias("event_id"), record.alias("record"))


@query
def lenient_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text days, some unreadable: those become null."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    text = F.when(key % 7 == 0, F.concat(F.lit("x"), day)).otherwise(day)
    return table(spark, sf_dir, "orders").select(key.alias("event_id"), lenient_day(text).alias("day"))


# --- Star schema ----------------------------------------------------------


@query
def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stage_events(integrated_orders(spark, sf_dir))


@query
def staging_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stage_series(integrated_orders(spark, sf_dir, located=False))


@query
def single_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrated_orders(spark, sf_dir, located=False).select(F.col(PEOPLE).alias("people"))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrated_orders(spark, sf_dir, located=False).agg(F.count(F.lit(1)).alias("rows"))


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(*_light_staging(spark, sf_dir))


@query
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_time(star.dim_date(*_light_staging(spark, sf_dir)))


def _light_staging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Day and type columns of both staging models, from one stored table."""
    integrated = stored_integrated(spark, sf_dir, located=False)
    columns = {old: new for old, new in STAGED_EVENT_COLUMNS.items() if new not in LOCATION_KEYS}
    return star.stage_events(integrated, columns), star.stage_series(integrated)


@query
def dim_location_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location(star.stage_events(integrated_orders(spark, sf_dir)))


@query
def dim_location_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location(star.stage_events(integrated_orders(spark, sf_dir)), "as_written")


@query
def dim_type_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_accident_type(_light_staging(spark, sf_dir)[0])


@query
def dim_type_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_accident_type(_light_staging(spark, sf_dir)[0], "as_written")


@query
def dim_weather_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_weather(_light_staging(spark, sf_dir)[1])


@query
def dim_weather_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_weather(_light_staging(spark, sf_dir)[1], "as_written")


@query
def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    integrated = stored_integrated(spark, sf_dir)
    return star.fact(star.stage_events(integrated), star.stage_series(integrated))


@query
def fact_split_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with no broadcast of its mappings: hot keys split off, the rest shuffled."""
    integrated = stored_integrated(spark, sf_dir)
    events, series = star.stage_events(integrated), star.stage_series(integrated)
    return star.fact(events, series, max_bytes=0, hot_keys=1_000)


@query
def fact_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over events in buckets of their location, which move once."""
    integrated = stored_integrated(spark, sf_dir)
    events = locate_events(star.stage_events(integrated), "located_events")
    return located_fact(events, star.stage_series(integrated), locations_of("located_events", events))


@query
def fact_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    integrated = stored_integrated(spark, sf_dir)
    events, series = star.stage_events(integrated), star.stage_series(integrated)
    return star.fact_wide(star.fact(events, series), star.dim_weather(series))


@query
def dense_keys_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys over many tuples: every user, type and value of the event log."""
    keys = ["user_id", "event_type", "value"]
    ranked = rank_tuples(table(spark, sf_dir, "events"), keys)
    return dense_keys(ranked, keys, "key").withColumnRenamed(COUNT, "rows")


# --- Sinks ----------------------------------------------------------------


@query
def parquet_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table that is listed, exported under its flat name and read back.

    The list is that of the catalog, of which the tables of this query are
    picked out; what came back is told by sums over columns of each table.
    """
    sums = {
        "region": ["r_regionkey"],
        "nation": ["n_nationkey", "n_regionkey"],
        "customer": ["c_custkey", "c_acctbal"],
        "supplier": ["s_suppkey", "s_acctbal"],
        "part": ["p_partkey", "p_retailprice"],
        "orders": ["o_orderkey", "o_totalprice"],
        "lineitem": ["l_orderkey", "l_extendedprice"],
        "events": ["event_id", "value"],
    }
    for name in sums:
        publish_model(table(spark, sf_dir, name), f"main_{name}", "view")
    listed = list_tables(spark)
    tables = {key: df for key, df in listed.items() if key[0] == TEMPORARY and export_name(key[1]) in sums}
    paths = dict(zip((export_name(name) for _, name in tables), export_parquet(tables, scratch_path(spark, "export"))))
    parts = []
    for name, columns in sums.items():
        total = reduce(add, (F.coalesce(F.sum(F.col(c).cast("decimal(28,2)")), F.lit(0)) for c in columns))
        total = total.cast("double").alias("total")
        back = read_table(spark, paths[name])
        parts.append(back.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), total))
    return reduce(DataFrame.union, parts)


@query
def export_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every given table, named as a view or a table of the catalog, listed, exported and read back.

    The export compares a digest of all columns itself; the result tells the
    content of each column in sums that SQL can say as well.
    """
    kept = "exported"
    for name in TABLES:
        # Small tables go to a schema of the catalog, the others are views of the session.
        as_table = name in ("region", "nation", "benchmark")
        if as_table:
            publish_model(table(spark, sf_dir, name), f"main_{name}", "table", scratch_path(spark, name), schema=kept)
        else:
            publish_model(table(spark, sf_dir, name), f"main_{name}", "view")
    # Views of other queries may have the names of these tables: a table of the catalog goes before them.
    listed = list_tables(spark)
    found = {name: key for key in sorted(listed) if (name := export_name(key[1])) in TABLES and key[0] in (TEMPORARY, kept)}
    paths = export_parquet({key: listed[key] for key in found.values()}, scratch_path(spark, "export-all"))
    parts = []
    for name, path in zip(found, paths):
        back = read_table(spark, path)
        counts = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("present"), _content(c, kind).alias("total")) for c, kind in TABLES[name].items()]
        summed = back.agg(F.count(F.lit(1)).alias("rows"), F.array(*counts).alias("columns"))
        parts.append(summed.select(F.lit(name).alias("table_name"), "rows", F.inline("columns")))
    return reduce(DataFrame.union, parts)


def _content(name: str, kind: str) -> Column:
    """A sum over the values of a column that is the same in any order of addition."""
    column = F.col(name)
    if kind == REAL:
        column = F.floor(column * 100)
    elif kind == VECTOR:
        whole = F.transform(column, lambda x: F.floor(x.cast("double") * 1000).cast("bigint"))
        column = F.aggregate(whole, F.lit(0).cast("bigint"), lambda so_far, x: so_far + F.coalesce(x, F.lit(0)))
    elif kind in (TEXT, MOMENT):
        text = timestamp_text(column) if kind == MOMENT else column
        column = F.conv(F.substring(F.md5(text), 1, 8), 16, 10)
    return F.coalesce(F.sum(column.cast("bigint")), F.lit(0))


@query
def series_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, one appended and one that replaces days, each read as the snapshot it left."""
    path = scratch_path(spark, "snapshots")
    series = stored_series(spark, sf_dir)
    late = series.filter(F.dayofmonth("date") > 15).withColumn("rain_sum", F.col("rain_sum") + 1)
    save_series(series, path, _load_time(1))
    save_series(late, path, _load_time(2), mode="append")
    save_series(late.withColumn("rain_sum", F.col("rain_sum") + 1), path, _load_time(3))
    parts = [
        read_series(spark, path, version=version).agg(
            F.lit(version).cast("bigint").alias("version"),
            F.count(F.lit(1)).alias("days"),
            F.countDistinct("date").alias("dates"),
            F.sum("rain_sum").alias("rain"),
        )
        for version in snapshot_versions(spark, path)
    ]
    return reduce(DataFrame.union, parts)


@query
def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The integrated table stored by year, replaced once and read back whole."""
    path = scratch_path(spark, "by-year")
    integrated = integrated_orders(spark, sf_dir, located=False).withColumn("year", F.year("date").cast("bigint"))
    for _ in range(2):
        save_table(integrated, path, ["year"])
    return read_table(spark, path).select(
        F.col(CASE_NUMBER).alias("event_id"), F.col("year").cast("bigint").alias("year"), F.col(PEOPLE).alias("people")
    )


@query
def published_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over the events and a table in a schema of the catalog, joined by name in SQL."""
    integrated = stored_integrated(spark, sf_dir)
    publish_model(star.stage_events(integrated), "staging_accidents", "view")
    weather = star.dim_weather(star.stage_series(integrated))
    publish_model(weather, "dim_weather", "table", scratch_path(spark, "model"), schema="dimensions")
    return spark.sql(
        """
        SELECT a.region, CAST(count(*) AS BIGINT) AS events, max(w.max_temperature) AS max_temperature
        FROM staging_accidents a JOIN dimensions.dim_weather w ON a.accident_date = w.weather_date
        GROUP BY a.region
        """
    )
