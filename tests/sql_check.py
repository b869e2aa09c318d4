"""Order-insensitive comparison of a Spark frame with the same query in SQL."""

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df, connection, sql):
    cursor = connection.execute(sql)
    wanted = _multiset([d[0] for d in cursor.description], cursor.fetchall())
    found = _multiset(df.columns, [tuple(r) for r in df.collect()])
    assert found[0] == wanted[0]
    assert sum(found[1].values()) == sum(wanted[1].values())
    missing = wanted[1] - found[1]
    extra = found[1] - wanted[1]
    assert not missing, f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
