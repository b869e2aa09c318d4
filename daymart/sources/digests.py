"""Digests of whole tables, alike in whatever order rows are read.

A row is hashed over all its columns, and which of them are null; the hashes
are summed. Equal tables have equal digests, and a value that is lost, changed
or moved to another column or row changes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns of a row, in the order of their names."""
    fields = sorted(df.schema.fields, key=lambda field: field.name)
    parts, missing = [], []
    for field in fields:
        column = F.col(f"`{field.name}`")
        missing.append(column.isNull())
        # Inside a nested value a null leaves no trace in a hash; its text has one.
        nested = isinstance(field.dataType, _NESTED)
        parts.append(F.to_json(F.struct(_sorted_entries(column, field.dataType)), {"ignoreNullFields": "false"}) if nested else column)
    return F.xxhash64(F.array(*missing), *parts) if fields else F.lit(0).cast("bigint")


def _sorted_entries(column: Column, kind: T.DataType) -> Column:
    return F.array_sort(F.map_entries(column)) if isinstance(kind, T.MapType) else column


def digest_columns(df: DataFrame) -> list[Column]:
    """Aggregates ``rows`` and ``digest`` of a table, also for an ``Observation`` of a write."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash(df).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    ]


def table_digest(df: DataFrame) -> tuple[int, int]:
    """Rows and digest of a table, in one pass that moves a row for each task."""
    found = df.agg(*digest_columns(df)).first()
    return found["rows"], int(found["digest"])
