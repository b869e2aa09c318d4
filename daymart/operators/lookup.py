"""Joins to a smaller side, with its size checked.

A stored side that is small enough is broadcast and the large side never
moves. Beyond that, ``lookup_key`` splits the hot keys off: they are few by
counting (a key with more than 1/N of the rows has fewer than N like it), so
their part of the mapping is broadcast; their rows are spread evenly while the
others meet the rest of the mapping in one shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 20_000
#: Tasks that the rows of one hot key, or of one day, are spread over at most.
SALTS = 256
_FIXED_BYTES = 16


def stored_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df`` in memory, roughly and from above.

    One pass with a map-side sum; meant for stored tables of dimension size.
    """
    width: Column = F.lit(_FIXED_BYTES * (len(df.columns) + 1))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"size of nested column {field.name} is not known")
    return df.agg(F.sum(width.cast("bigint")).alias("bytes")).first()["bytes"] or 0


def row_salt(rows: DataFrame, salts: int = SALTS) -> Column:
    """A number below ``salts`` that a row has whenever it is computed.

    Not one of its place: a task that is run again may meet shuffled rows in
    another order, and a row with another number would go to another reducer.
    """
    hashed = [f"`{f.name}`" for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its stored size allows one.

    Without the hint the join shuffles both sides, and adaptive execution
    splits a partition that one hot day fills.
    """
    return F.broadcast(df) if stored_bytes(df) <= max_bytes else df


def _keys_of(mapping: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """``mapping`` with its key columns renamed, so both sides can be named freely."""
    return mapping.select(*(F.col(c).alias(f"_of_{c}") for c in on), *values)


def _join(rows: DataFrame, keyed: DataFrame, on: list[str], how: str) -> DataFrame:
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on))
    return rows.join(keyed, same, how).drop(*(f"_of_{c}" for c in on))


def lookup_key(
    rows: DataFrame,
    mapping: DataFrame,
    on: list[str],
    values: list[str],
    *,
    count_column: str,
    max_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    hot_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of ``rows`` to ``mapping``, which holds each ``on`` tuple once.

    Nulls match nulls. ``mapping`` must be stored and say in ``count_column``
    how many rows have each tuple. Beyond ``max_bytes`` the hot keys' part of it
    is broadcast and the rows they answer are spread by a salt that matches
    nothing, so ``rows`` is read once and no hot key fills a task. The salt is
    a hash of the whole row, so a row that is read again goes where it went
    before; rows that are equal in all columns share one. Hot keys are
    those of the mapping's counts: give it the counts of these rows, as a key
    that became hot since is only split by adaptive execution.
    """
    keyed = _keys_of(mapping, on, [*values, count_column])
    if stored_bytes(mapping) <= max_bytes:
        return _join(rows, F.broadcast(keyed), on, "left").drop(count_column)

    total = mapping.agg(F.sum(count_column).alias("total")).first()["total"]
    is_hot = F.col(count_column) * F.lit(hot_keys) > F.lit(total)
    keys = [f"_of_{c}" for c in on]
    hot = keyed.filter(is_hot).drop(count_column)
    if stored_bytes(hot) > hot_bytes:
        # Few keys, but very wide ones. Adaptive execution splits their rows.
        return _join(rows, keyed, on, "left").drop(count_column)
    hot = hot.select(*keys, *(F.col(v).alias(f"_hot_{v}") for v in values), F.lit(True).alias("_is_hot"))
    marked = _join(rows, F.broadcast(hot), on, "left")
    spread = F.when(F.col("_is_hot"), 1 + row_salt(rows)).otherwise(0)
    marked = marked.withColumn("_salt", spread)

    cold = keyed.filter(~is_hot).select(*keys, *(F.col(v).alias(f"_cold_{v}") for v in values), F.lit(0).alias("_of_salt"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on), F.col("_salt") == F.col("_of_salt"))
    joined = marked.join(cold, same, "left")
    found = [F.when(F.col("_is_hot"), F.col(f"_hot_{v}")).otherwise(F.col(f"_cold_{v}")).alias(v) for v in values]
    return joined.select(*(f"`{c}`" for c in rows.columns), *found)
