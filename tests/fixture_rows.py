"""Ten raw event rows, each tripping one rule, and four days of the series."""

import csv
import json

from daymart.schemas import (
    CASE_NUMBER,
    DEATHS,
    DETAIL,
    DRUNK_DRIVER,
    EASTING,
    EVENT_TIME,
    INJURIES,
    KEPT_COLUMNS,
    MUNICIPALITY,
    NORTHING,
    PEOPLE,
    REGION,
    SETTLEMENT,
    TYPE,
    VEHICLES,
)

TIME_FORMAT = "yyyy-MM-dd HH:mm"

#  id, when, people, deaths, vehicles, injuries, region, settlement, flag, x, y
_HARJU = ("6588900", "542700")
_TARTU = ("6474000", "659000")
_ROWS = [
    ("1", "2020-01-05 08:10", 2, 0, 2, 1, "Harju maakond", "JAH", 0, *_HARJU),
    ("2", "2020-01-05 23:59", 3, 1, 1, 2, "Harju maakond", "JAH", 0, *_HARJU),
    ("3", "2020-01-05 10:00", 1, 0, 1, 0, "Harju maakond", "JAH", 0, "", "542700"),
    ("X12", "2020-01-05 10:00", 1, 0, 1, 0, "Harju maakond", "JAH", 0, *_HARJU),
    ("5", "2020-01-05 10:00", 1, 0, 1, 0, "Tallinn", "JAH", 0, *_HARJU),
    ("6", "2020-01-05 10:00", 1, 0, 1, 0, "Harju maakond", "jah", 0, *_HARJU),
    ("7", "2020-04-01 10:00", 1, 0, 1, 0, "Harju maakond", "EI", 0, *_HARJU),
    ("8", "2020-02-10 07:00", 1, 0, 1, 0, "Tartu maakond", "EI", 1, *_TARTU),
    ("9", "2020-02-11 07:00", 4, 0, 2, 3, "Tartu maakond", "EI", 0, *_TARTU),
    ("1", "2020-01-05 08:10", 2, 0, 2, 1, "Harju maakond", "JAH", 0, *_HARJU),
]
_COLUMNS = [CASE_NUMBER, EVENT_TIME, PEOPLE, DEATHS, VEHICLES, INJURIES, REGION, SETTLEMENT, DRUNK_DRIVER, NORTHING, EASTING]


def raw_rows():
    for values in _ROWS:
        row = {name: "0" for name in KEPT_COLUMNS}
        row.update(zip(_COLUMNS, map(str, values)))
        row[MUNICIPALITY] = "Tartu linn" if row[REGION].startswith("Tartu") else "Tallinn"
        row[TYPE], row[DETAIL] = "Kokkupõrge", "Külgkokkupõrge"
        if row[CASE_NUMBER] == "8":
            row[TYPE], row[DETAIL] = "Ühesõidukiõnnetus", "Teelt väljasõit"
        row["Not kept"] = "extra; quoted"
        yield row


def write_raw_csv(path, **changes):
    """The rows as a file whose columns stand in another order than ours."""
    header = sorted([*KEPT_COLUMNS, "Not kept"])
    with open(path, "w", encoding="utf-8", newline="") as out:
        writer = csv.DictWriter(out, header, delimiter=";")
        writer.writeheader()
        for row in raw_rows():
            writer.writerow({**row, **changes})


PAYLOAD = {
    "daily": {
        "time": ["2020-01-05", "2020-02-10", "2020-02-11", "2020-03-01"],
        "temperature_2m_max": [2.0, -5.0, 6.0, 9.0],
        "temperature_2m_min": [-10.0, -12.5, 0.5, 3.0],
        "precipitation_sum": [12.0, 0.0, 31.0, 5.0],
        "snowfall_sum": [1.0, 0.0, 0.0, 0.0],
        "rain_sum": [11.0, 0.0, 31.0, 5.0],
    }
}


def write_payload(path, payload=PAYLOAD):
    path.write_text(json.dumps(payload, indent=1), encoding="utf-8")
