"""SQL for the registered queries, to check them against another engine.

Written straight from the definitions: windows over whole tables, joins on
natural keys, nothing pre-aggregated.
"""

from __future__ import annotations

from daymart.plans.given_tables import MOMENT, REAL, TABLES, TEXT, VECTOR, WHOLE
from daymart.schemas import ALLOWED_REGIONS

# The projection's constants, worked out by hand from the textbook form of the
# Lambert conformal conic with two standard parallels (m and t of 58 and 59 1/3
# degrees, GRS80), so that a wrong constant of the library shows.
ECCENTRICITY = 0.08181919104281579
CONE = 0.8541758580870784
RADIUS_SCALE = 11473298.038394244
ORIGIN_RADIUS = 4020205.4786358215
ORIGIN_LONGITUDE = 24.0
FALSE_EASTING = 500000.0
FALSE_NORTHING = 6375000.0
LATITUDE_PASSES = 8

DAY = "CAST(o.o_orderdate AS DATE)"

EVENTS = f"""
ev AS (
  SELECT o.o_orderkey AS event_id, {DAY} AS event_date,
    CAST(sum(l.l_quantity) AS BIGINT) AS people, count(*) AS vehicles,
    CAST(sum(l.l_linenumber) AS BIGINT) AS injuries,
    CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS deaths,
    max(r.r_name) AS region, max(n.n_name) AS municipality, max(c.c_mktsegment) AS settlement,
    max(c.c_acctbal) AS x, CAST(max(c.c_custkey) AS DOUBLE) AS y,
    max(o.o_orderpriority) AS type, max(o.o_orderstatus) AS detail,
    CAST(max(CASE o.o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.0 END) AS DOUBLE) AS flag
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  GROUP BY o.o_orderkey, {DAY})
"""
DAILY = """
sums AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) % 50 - 25 AS low,
    count(*) % 10 AS spread, CAST(sum(l_linenumber) AS BIGINT) % 45 AS wet
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE)),
daily AS (
  SELECT date, CAST(low + spread AS DOUBLE) AS temperature_max, CAST(low AS DOUBLE) AS temperature_min,
    CAST(wet AS DOUBLE) AS precipitation_sum,
    CAST(CASE WHEN low < 0 THEN wet ELSE 0 END AS DOUBLE) AS snowfall_sum,
    CAST(CASE WHEN low < 0 THEN 0 ELSE wet END AS DOUBLE) AS rain_sum
  FROM sums)
"""
INTEGRATED = f"""{EVENTS}, {DAILY},
integ AS (SELECT * FROM ev JOIN daily ON ev.event_date = daily.date)
"""
STAGED = f"""{INTEGRATED},
sa AS (
  SELECT event_id AS accident_id, event_date AS accident_date, people AS num_people_involved,
    deaths AS num_deaths, vehicles AS num_vehicles_involved, injuries AS num_injuries,
    region, municipality, settlement, type AS accident_type, detail AS accident_detail,
    flag AS drunk_driver_involved, x AS x_coordinate, y AS y_coordinate
  FROM integ),
sw AS (
  SELECT date AS weather_date, temperature_max AS max_temperature, temperature_min AS min_temperature,
    precipitation_sum AS precipitation, snowfall_sum AS snowfall, rain_sum AS rainfall
  FROM integ)
"""
LOCATION = "region, municipality, settlement, x_coordinate, y_coordinate"
WEATHER = "weather_date, max_temperature, min_temperature, precipitation, snowfall, rainfall"
BOOLEAN_FLAG = """CASE WHEN drunk_driver_involved = 1.0 THEN TRUE
  WHEN drunk_driver_involved = 0.0 THEN FALSE END AS drunk_driver_involved"""

DATES = """
dates AS (
  SELECT row_number() OVER (ORDER BY d NULLS LAST) AS date_key, d AS full_date,
    CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day,
    CAST(dayofweek(d) AS BIGINT) AS day_of_week
  FROM (SELECT accident_date AS d FROM sa UNION SELECT weather_date FROM sw))
"""
FACT = f"""{STAGED}, {DATES},
days AS (SELECT DISTINCT weather_date FROM sw),
base AS (SELECT DISTINCT sa.*, days.weather_date FROM sa LEFT JOIN days ON accident_date = weather_date),
locations AS (
  SELECT row_number() OVER (ORDER BY {LOCATION}) AS location_key, *
  FROM (SELECT DISTINCT {LOCATION} FROM sa)),
types AS (
  SELECT row_number() OVER (ORDER BY accident_type, accident_detail, drunk_driver_involved NULLS LAST)
    AS accident_type_key, *
  FROM (SELECT DISTINCT accident_type, accident_detail, {BOOLEAN_FLAG} FROM sa)),
weather AS (SELECT row_number() OVER (ORDER BY weather_date) AS weather_key, weather_date FROM days),
facts AS (
  SELECT accident_id, date_key, location_key, accident_type_key, weather_key,
    num_people_involved, num_deaths, num_vehicles_involved, num_injuries
  FROM (SELECT * EXCLUDE (drunk_driver_involved), {BOOLEAN_FLAG} FROM base)
  LEFT JOIN dates ON full_date = accident_date
  LEFT JOIN locations USING ({LOCATION})
  LEFT JOIN types USING (accident_type, accident_detail, drunk_driver_involved)
  LEFT JOIN weather USING (weather_date))
"""


def _banded(column: str, bands: str, case: str, label: str, measures: str) -> str:
    return f"""
    WITH {INTEGRATED},
    bands(band_idx, {label}) AS (VALUES {bands}),
    totals AS (SELECT {case} AS band_idx, {measures} FROM integ GROUP BY 1)
    SELECT bands.band_idx, bands.{label}, {column}
    FROM bands LEFT JOIN totals ON totals.band_idx = bands.band_idx
    """


SEVERITY = _banded(
    "totals.Injuries, totals.Fatalities",
    "(0, '< -10°C'), (1, '-10°C to 0°C'), (2, '0°C to 10°C'), (3, '10°C to 20°C'), (4, '> 20°C')",
    """CASE WHEN temperature_min <= -10 THEN 0 WHEN temperature_min <= 0 THEN 1
       WHEN temperature_min <= 10 THEN 2 WHEN temperature_min <= 20 THEN 3
       WHEN temperature_min > 20 THEN 4 END""",
    "temperature_category",
    "avg(injuries) AS Injuries, avg(deaths) AS Fatalities",
)
INVOLVED = _banded(
    "CAST(coalesce(totals.Vehicles, 0) AS BIGINT) AS Vehicles, CAST(coalesce(totals.People, 0) AS BIGINT) AS People",
    "(0, '0-10 mm'), (1, '10-20 mm'), (2, '20-30 mm'), (3, '> 30 mm')",
    """CASE WHEN precipitation_sum <= 0 THEN NULL WHEN precipitation_sum <= 10 THEN 0
       WHEN precipitation_sum <= 20 THEN 1 WHEN precipitation_sum <= 30 THEN 2
       WHEN precipitation_sum > 30 THEN 3 END""",
    "precipitation_category",
    "sum(vehicles) AS Vehicles, sum(people) AS People",
)

TREND_WEATHER = "avg(temperature_min) AS temperature_min, avg(temperature_max) AS temperature_max"
TREND_SUMS = "CAST(sum(people) AS BIGINT) AS people, CAST(sum(precipitation_sum) AS DOUBLE) AS precipitation"


def _month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def _trend(rows: str, source: str) -> str:
    return f"""
    WITH {INTEGRATED}{rows}
    SELECT {_month("date")} AS "YearMonth", {TREND_SUMS}, {TREND_WEATHER},
      (avg(temperature_min) + avg(temperature_max)) / 2 AS temperature_avg
    FROM {source} GROUP BY 1
    """


BY_DAY = """,
per_day AS (
  SELECT date, sum(people) AS people, max(precipitation_sum) AS precipitation_sum,
    max(temperature_min) AS temperature_min, max(temperature_max) AS temperature_max
  FROM integ GROUP BY date)"""

TREND_JOINED = f"""
WITH {INTEGRATED},
involved AS (SELECT {_month("event_date + 20")} AS m, {TREND_SUMS} FROM integ GROUP BY 1),
weather AS (SELECT {_month("date")} AS m, {TREND_WEATHER} FROM integ GROUP BY 1)
SELECT involved.m AS "YearMonth", people, precipitation, temperature_min, temperature_max,
  (temperature_min + temperature_max) / 2 AS temperature_avg
FROM involved JOIN weather ON involved.m = weather.m
"""


def _wgs84(source: str, easting: str, northing: str) -> str:
    """Inverse projection of ``source``: radians of longitude and latitude as lam, phi."""
    passes = "".join(
        f""",
    pass{i} AS (SELECT *, tanh(iso + {ECCENTRICITY!r} * atanh({ECCENTRICITY!r} * s{i - 1})) AS s{i}
      FROM pass{i - 1})"""
        for i in range(1, LATITUDE_PASSES + 1)
    )
    return f"""
    flat AS (SELECT *, {easting} - {FALSE_EASTING!r} AS de,
      {ORIGIN_RADIUS!r} - ({northing} - {FALSE_NORTHING!r}) AS ds FROM {source}),
    cone AS (SELECT *, atan2(de, ds) / {CONE!r} AS lam,
      ln({RADIUS_SCALE!r} / sqrt(de * de + ds * ds)) / {CONE!r} AS iso FROM flat),
    pass0 AS (SELECT *, tanh(iso) AS s0 FROM cone){passes},
    wgs AS (SELECT *, round(degrees(lam) + {ORIGIN_LONGITUDE!r}, 7) AS longitude,
      round(degrees(asin(s{LATITUDE_PASSES})), 7) AS latitude FROM pass{LATITUDE_PASSES})
    """


ON_MAP = "mapped AS (SELECT *, y % 300000.0 + 400000 AS east, x * 20 + 6375000 AS north FROM {source})"

_REGIONS = ", ".join(f"'{name}'" for name in [*ALLOWED_REGIONS, "Tallinn"])
_ALLOWED = ", ".join(f"'{name}'" for name in ALLOWED_REGIONS)
CLEANED = f"""
WITH raw AS (
  SELECT *, [{_REGIONS}][1 + o_custkey % 16] AS region,
    CASE o_orderstatus WHEN 'F' THEN 'JAH' WHEN 'O' THEN 'EI' ELSE 'jah' END AS settlement
  FROM orders)
SELECT o_orderkey AS accident_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:00') AS accident_date,
  o_orderkey % 9 AS num_people_involved, o_orderkey % 2 AS num_deaths,
  o_orderkey % 4 AS num_vehicles_involved, o_orderkey % 5 AS num_injuries,
  region, o_orderpriority AS municipality, settlement, o_orderpriority AS accident_type,
  CASE WHEN o_orderkey % 5 = 0 THEN ' ' || o_orderstatus || ' "a"; b,' || chr(10) || ' c ' ELSE o_orderstatus END
    AS accident_detail, CAST(o_orderkey % 2 AS DOUBLE) AS drunk_driver_involved,
  CAST(o_custkey * 10 AS DOUBLE) AS x_coordinate, CAST(o_custkey AS DOUBLE) AS y_coordinate
FROM raw
WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
  AND region IN ({_ALLOWED}) AND settlement IN ('JAH', 'EI')
"""

_ORDER_TEXTS = """texts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) END AS price,
    lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') AS code,
    CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'False' END AS flag,
    strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day,
    strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30' AS moment,
    lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') || '/' || lpad(CAST(o_orderkey % 11 + 1 AS VARCHAR), 2, '0') || '/1997' AS either,
    CASE WHEN o_orderkey % 1000 = 1 THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y')
      ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS mixed,
    CASE WHEN o_orderkey < 0 THEN 'x' END AS nothing
  FROM orders)"""
_TEXT_COLUMNS = ("key", "price", "code", "flag", "day", "moment", "either", "mixed", "nothing")
_LAYOUT_COUNTS = " UNION ALL ".join(
    f"SELECT name, '{day + time}' AS layout, count(*) AS fitting FROM each_value WHERE shape = '{day_shape + time_shape}' "
    f"AND try_strptime(v, '{day_format + time_format}') IS NOT NULL GROUP BY name"
    for day, day_format, day_shape in (
        ("yyyy-MM-dd", "%Y-%m-%d", "9999-99-99"),
        ("yyyy/MM/dd", "%Y/%m/%d", "9999/99/99"),
        ("dd.MM.yyyy", "%d.%m.%Y", "99.99.9999"),
        ("dd/MM/yyyy", "%d/%m/%Y", "99/99/9999"),
        ("MM/dd/yyyy", "%m/%d/%Y", "99/99/9999"),
        ("dd-MM-yyyy", "%d-%m-%Y", "99-99-9999"),
        ("MM-dd-yyyy", "%m-%d-%Y", "99-99-9999"),
    )
    for time, time_format, time_shape in (("", "", ""), (" HH:mm", " %H:%M", " 99:99"), (" HH:mm:ss", " %H:%M:%S", " 99:99:99"))
)
_FOUND_TYPES = f"""
    WITH {_ORDER_TEXTS},
    every AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, nullif({c}, '') AS v FROM texts" for c in _TEXT_COLUMNS)}),
    each_value AS (SELECT *, regexp_replace(v, '[0-9]', '9', 'g') AS shape FROM every),
    counted AS (
      SELECT name, count(*) AS n_rows, count(v) AS n_values,
        count(*) FILTER (regexp_full_match(v, '[+-]?(0|[1-9][0-9]{{0,17}})')) AS whole,
        count(*) FILTER (regexp_full_match(v, '[+-]?(0|[1-9][0-9]*)([.][0-9]*)?')) AS number,
        count(*) FILTER (lower(v) IN ('true', 'false')) AS truth
      FROM each_value GROUP BY name),
    fits AS ({_LAYOUT_COUNTS}),
    taken AS (
      SELECT c.name, count(*) AS n, string_agg(layout, ',' ORDER BY layout) AS candidates
      FROM counted c JOIN fits f ON c.name = f.name AND c.n_values = f.fitting GROUP BY c.name)
    SELECT name AS "column", n_rows, n_values,
      CASE WHEN n_values = 0 THEN 'string' WHEN whole = n_values THEN 'bigint' WHEN number = n_values THEN 'double'
        WHEN truth = n_values THEN 'boolean' WHEN n IS NULL OR n > 1 THEN 'string'
        WHEN contains(candidates, 'H') THEN 'timestamp' ELSE 'date' END AS type,
      CASE WHEN n = 1 THEN candidates END AS time_format, coalesce(candidates, '') AS candidates
    FROM counted LEFT JOIN taken USING (name)
"""
CONTENT = {
    WHOLE: "{c}",
    REAL: "floor({c} * CAST(100 AS DOUBLE))",
    TEXT: "CAST('0x' || substr(md5({c}), 1, 8) AS BIGINT)",
    MOMENT: "CAST('0x' || substr(md5(strftime({c}, '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT)",
    VECTOR: "list_sum(list_transform({c}, lambda v: CAST(floor(CAST(v AS DOUBLE) * 1000) AS BIGINT)))",
}
ALL_TABLES = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS "rows", '{c}' AS column_name, count({c}) AS present,
      CAST(coalesce(sum(CAST({CONTENT[kind].format(c=c)} AS BIGINT)), 0) AS BIGINT) AS total FROM {name}"""
    for name, columns in TABLES.items()
    for c, kind in columns.items()
)

EXPECTED_SQL: dict[str, str] = {
    "export_all_tables": ALL_TABLES,
    "series_snapshots": f"""
        WITH {DAILY},
        late AS (SELECT * REPLACE (rain_sum + 1 AS rain_sum) FROM daily WHERE day(date) > 15),
        kept AS (
          SELECT 1 AS version, * FROM daily
          UNION ALL SELECT 2, * FROM daily UNION ALL SELECT 2, * FROM late
          UNION ALL SELECT 3, * FROM daily WHERE day(date) <= 15
          UNION ALL SELECT 3, * REPLACE (rain_sum + 1 AS rain_sum) FROM late)
        SELECT CAST(version AS BIGINT) AS version, count(*) AS days, count(DISTINCT date) AS dates, sum(rain_sum) AS rain
        FROM kept GROUP BY version
    """,
    "weight_around_places": f"""
        WITH {INTEGRATED}, {ON_MAP.format(source="integ")},
        places AS (SELECT east AS x, north AS y, sum(people) AS weight, count(*) AS events FROM mapped GROUP BY east, north)
        SELECT a.x, a.y, CAST(sum(b.weight) AS BIGINT) AS weight, CAST(sum(b.events) AS BIGINT) AS events
        FROM places a JOIN places b ON (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) <= 2000.0::DOUBLE * 2000
        GROUP BY a.x, a.y
    """,
    "severity_by_temperature": SEVERITY,
    "involved_by_precipitation": INVOLVED,
    "monthly_trend": _trend("", "integ"),
    "monthly_trend_by_day": _trend(BY_DAY, "per_day"),
    "monthly_trend_joined": TREND_JOINED,
    "count_by_region_type": f"""
        WITH {INTEGRATED}
        SELECT region, type AS accident_type, count(*) AS total_accidents FROM integ GROUP BY region, type
    """,
    "density_grid": f"""
        WITH {INTEGRATED}, {ON_MAP.format(source="integ")},
        cells AS (
          SELECT CAST(floor(east / 10000) AS BIGINT) AS cell_x, CAST(floor(north / 10000) AS BIGINT) AS cell_y,
            CAST(sum(people) AS BIGINT) AS weight, count(*) AS events
          FROM mapped GROUP BY 1, 2),
        {_wgs84("cells", "(cell_x + 0.5::DOUBLE) * 10000", "(cell_y + 0.5::DOUBLE) * 10000")}
        SELECT cell_x, cell_y, weight, events, longitude AS "Longitude", latitude AS "Latitude" FROM wgs
    """,
    "map_points": f"""
        WITH {INTEGRATED}, {ON_MAP.format(source="integ")}, {_wgs84("mapped", "east", "north")}
        SELECT latitude AS "Latitude", longitude AS "Longitude", precipitation_sum AS "Precipitation (mm)",
          injuries AS "Injured", date AS "Date"
        FROM wgs
    """,
    "crs_inverse": f"""
        WITH {EVENTS}, {ON_MAP.format(source="ev")}, {_wgs84("mapped", "east", "north")}
        SELECT event_id, longitude AS "Longitude", latitude AS "Latitude" FROM wgs
    """,
    "latest_log": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value
        FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 100
    """,
    "first_rows": f"""
        WITH {INTEGRATED}
        SELECT event_id AS accident_id, event_date AS accident_date FROM integ ORDER BY event_id LIMIT 5
    """,
    "clean_validate": CLEANED,
    "rejected_events": f"""
        WITH raw AS (
          SELECT o_orderkey AS k, [{_REGIONS}][1 + o_custkey % 16] AS region, o_orderstatus AS status FROM orders),
        judged AS (
          SELECT k % 13 = 0 OR k % 17 = 0 AS missing, k % 11 = 0 AS case_number, k % 19 = 0 AS unreadable,
            region IS NOT NULL AND region NOT IN ({_ALLOWED}) AS region, status NOT IN ('F', 'O') AS settlement,
            region IS NULL AS no_region
          FROM raw),
        named AS (
          SELECT unnest(list_filter([
            CASE WHEN missing OR no_region THEN 'missing' END, CASE WHEN case_number THEN 'case_number' END,
            CASE WHEN unreadable THEN 'unreadable' END, CASE WHEN region THEN 'region' END,
            CASE WHEN settlement THEN 'settlement' END,
            CASE WHEN NOT (missing OR no_region OR case_number OR unreadable OR coalesce(region, false) OR settlement) THEN 'none' END],
            lambda r: r IS NOT NULL)) AS rule
          FROM judged)
        SELECT rule, count(*) AS events FROM named GROUP BY rule
    """,
    "found_types": _FOUND_TYPES,
    "typed_by_finding": f"""
        WITH {_ORDER_TEXTS}
        SELECT CAST(key AS BIGINT) AS key, CAST(round(CAST(nullif(price, '') AS DOUBLE) * 100) AS BIGINT) AS cents, code,
          lower(flag) = 'true' AS flag, CAST(day AS DATE) AS day,
          strftime(strptime(moment, '%d.%m.%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS moment,
          CAST(strptime(either, '%m/%d/%Y') AS DATE) AS either, mixed
        FROM texts
    """,
    "csv_round_trip": CLEANED,
    "integrate_daily": f"""
        WITH {INTEGRATED}
        SELECT event_id, event_date, people, date, temperature_max, temperature_min, precipitation_sum,
          snowfall_sum, rain_sum
        FROM integ
    """,
    "integrate_appended": f"""
        WITH {INTEGRATED}
        SELECT date, 2 * count(*) AS events, CAST(2 * sum(people) AS BIGINT) AS people FROM integ GROUP BY date
    """,
    "keyed_replace_series": f"""
        WITH {DAILY},
        loads AS (
          SELECT *, 1 AS loaded_at FROM daily
          UNION ALL
          SELECT * REPLACE (rain_sum + 1 AS rain_sum), 2 FROM daily WHERE day(date) > 15)
        SELECT * EXCLUDE (rn, loaded_at), CAST(loaded_at AS BIGINT) AS loaded_at
        FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY loaded_at DESC) AS rn FROM loads)
        WHERE rn = 1
    """,
    "series_reload": f"WITH {DAILY} SELECT * FROM daily",
    "series_documents": f"WITH {DAILY} SELECT * FROM daily",
    "series_range": f"WITH {DAILY} SELECT * FROM daily WHERE date BETWEEN '1994-01-01' AND '1996-12-31'",
    "daily_array_unzip": f"WITH {DAILY} SELECT * FROM daily",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "json_rows": f"""
        WITH {EVENTS}
        SELECT event_id, '{{"event_id":' || event_id || ',"day":"' || event_date || '","people":' || people || '}}'
          AS record
        FROM ev
    """,
    "lenient_days": """
        SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders
    """,
    "staging_events": f"WITH {STAGED} SELECT * FROM sa",
    "staging_series": f"WITH {STAGED} SELECT * FROM sw",
    "single_column": f"WITH {INTEGRATED} SELECT people FROM integ",
    "row_count": f'WITH {INTEGRATED} SELECT count(*) AS "rows" FROM integ',
    "dim_date": f"WITH {STAGED}, {DATES} SELECT * FROM dates",
    "dim_time": f"WITH {STAGED}, {DATES} SELECT full_date AS date, year FROM dates",
    "dim_location_conformed": f"""
        WITH {STAGED}
        SELECT row_number() OVER (ORDER BY {LOCATION}) AS location_key, *
        FROM (SELECT DISTINCT {LOCATION} FROM sa)
    """,
    "dim_location_as_written": f"""
        WITH {STAGED} SELECT row_number() OVER (ORDER BY {LOCATION}) AS location_key, {LOCATION} FROM sa
    """,
    "dim_type_conformed": f"""
        WITH {STAGED}
        SELECT row_number() OVER (ORDER BY accident_type, accident_detail, drunk_driver_involved NULLS LAST)
          AS accident_type_key, *
        FROM (SELECT DISTINCT accident_type, accident_detail, {BOOLEAN_FLAG} FROM sa)
    """,
    "dim_type_as_written": f"""
        WITH {STAGED}
        SELECT row_number() OVER (ORDER BY accident_type, accident_detail, sa.drunk_driver_involved NULLS LAST)
          AS accident_type_key, accident_type, accident_detail, {BOOLEAN_FLAG}
        FROM sa
    """,
    "dim_weather_conformed": f"""
        WITH {STAGED}
        SELECT row_number() OVER (ORDER BY weather_date) AS weather_key, * FROM (SELECT DISTINCT {WEATHER} FROM sw)
    """,
    "dim_weather_as_written": f"""
        WITH {STAGED} SELECT row_number() OVER (ORDER BY weather_date) AS weather_key, {WEATHER} FROM sw
    """,
    "fact": f"WITH {FACT} SELECT * FROM facts",
    "fact_split_hot_keys": f"WITH {FACT} SELECT * FROM facts",
    "fact_located": f"WITH {FACT} SELECT * FROM facts",
    "fact_wide": f"""
        WITH {FACT},
        highs AS (SELECT weather_date, max(max_temperature) AS max_temperature FROM sw GROUP BY weather_date)
        SELECT facts.*, highs.max_temperature
        FROM facts LEFT JOIN weather ON weather.weather_key = facts.weather_key
        LEFT JOIN highs ON highs.weather_date = weather.weather_date
    """,
    "dense_keys_events": """
        SELECT row_number() OVER (ORDER BY user_id, event_type, value) AS key, user_id, event_type, value, rows
        FROM (SELECT user_id, event_type, value, count(*) AS rows FROM events GROUP BY ALL)
    """,
    "parquet_export": """
        SELECT 'region' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(r_regionkey AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM region
        UNION ALL SELECT 'nation' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(n_nationkey AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(n_regionkey AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM nation
        UNION ALL SELECT 'customer' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(c_custkey AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(c_acctbal AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM customer
        UNION ALL SELECT 'supplier' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(s_suppkey AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(s_acctbal AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM supplier
        UNION ALL SELECT 'part' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(p_partkey AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(p_retailprice AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM part
        UNION ALL SELECT 'orders' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(o_orderkey AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(o_totalprice AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM orders
        UNION ALL SELECT 'lineitem' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(l_orderkey AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(l_extendedprice AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM lineitem
        UNION ALL SELECT 'events' AS table_name, count(*) AS "rows", CAST(coalesce(sum(CAST(event_id AS DECIMAL(28,2))), 0) + coalesce(sum(CAST(value AS DECIMAL(28,2))), 0) AS DOUBLE) AS total FROM events
    """,
    "partitioned_table": f"""
        WITH {INTEGRATED}
        SELECT event_id, CAST(year(date) AS BIGINT) AS year, people FROM integ
    """,
    "published_models": f"""
        WITH {STAGED}
        SELECT region, count(*) AS events, max(max_temperature) AS max_temperature
        FROM sa JOIN (SELECT DISTINCT weather_date, max_temperature FROM sw) w ON accident_date = weather_date
        GROUP BY region
    """,
}
