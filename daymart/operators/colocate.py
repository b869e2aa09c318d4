"""Rows stored where their keys meet.

``co_locate`` shuffles a table once, by a tuple of its columns, and stores it in
buckets. Whatever groups or joins by that tuple afterwards reads the buckets as
they are: keys, lookups and distinct rows cost no further exchange of rows.

A tuple that stands for many rows would fill its bucket. Such tuples are few by
counting, and their rows are spread by a hash of columns that equal rows share,
so equal rows still meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.operators.keys import COUNT, dense_keys, rank_tuples
from daymart.operators.lookup import HOT_KEYS, SALTS, lookup_key
from daymart.operators.scratch import scratch_path, settle

#: The tuple as one text, and the part of it that a row belongs to.
PLACE, SPREAD = "_place", "_spread"
_ROWS_PER_BUCKET = 2_000_000
_MOST_BUCKETS = 20_000


def place_text(df: DataFrame, keys: list[str]) -> Column:
    """The tuple of ``keys`` as one text, never null: equal tuples have equal texts, others do not.

    Buckets know equality only, not the one by which nulls match; here a null
    is a text of its own. Columns are texts, numbers, booleans or dates.
    """
    parts = []
    for key in keys:
        kind, column = df.schema[key].dataType, F.col(f"`{key}`")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            column = column + F.lit(0.0).cast(kind)  # one zero
        elif not isinstance(kind, (T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType)):
            raise TypeError(f"{key} is of type {kind.simpleString()}, which has no text of its own for each value")
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def _buckets_for(df: DataFrame, rows: int) -> int:
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(_MOST_BUCKETS, max(least, -(-rows // _ROWS_PER_BUCKET)))


def store_buckets(df: DataFrame, table: str, buckets: int) -> DataFrame:
    """``df`` as a catalog table in buckets of ``PLACE`` and ``SPREAD``, one file each."""
    spark = df.sparkSession
    writer = df.repartition(buckets, PLACE, SPREAD).write.bucketBy(buckets, PLACE, SPREAD).sortBy(PLACE, SPREAD)
    writer.format("parquet").option("path", scratch_path(spark, "buckets")).mode("overwrite").saveAsTable(table)
    return spark.table(table)


def co_locate(
    rows: DataFrame,
    keys: list[str],
    spread_by: list[str],
    table: str,
    *,
    buckets: int | None = None,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """``rows``, a stored table, in buckets of the tuple of ``keys``.

    A tuple with more than 1/``hot_keys`` of the rows is spread by a hash of
    ``spread_by``: columns that rows which must meet agree in. Rows that agree
    in the tuple and in all of these share a bucket whatever their number.
    """
    placed = rows.withColumn(PLACE, place_text(rows, keys))
    # Copies collapse before this shuffle, which moves tuples and not rows.
    counts = settle(placed.groupBy(PLACE).agg(F.count(F.lit(1)).alias(COUNT)), "places")
    total = counts.agg(F.sum(COUNT).alias("total")).first()["total"] or 0
    # Fewer than ``hot_keys`` numbers. Another place of the same hash is spread with them.
    hot = counts.filter(F.col(COUNT) * hot_keys > F.lit(total)).select(F.xxhash64(PLACE).alias("_hot")).distinct()
    marked = placed.join(F.broadcast(hot), F.xxhash64(PLACE) == F.col("_hot"), "left")
    part = 1 + F.pmod(F.xxhash64(*(f"`{c}`" for c in spread_by)), F.lit(SALTS))
    spread = F.when(F.col("_hot").isNull(), 0).otherwise(part).cast("int")
    return store_buckets(marked.withColumn(SPREAD, spread).drop("_hot"), table, buckets or _buckets_for(rows, total))


def bucket_count(spark, table: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(described["data_type"])


def key_places(located: DataFrame, keys: list[str], key_name: str, table: str, buckets: int) -> DataFrame:
    """The dense key of each place and part of ``located``, in the same buckets, beside the tuple itself."""
    parts = settle(located.select(PLACE, SPREAD, *keys).distinct(), "parts")
    mapping = dense_keys(rank_tuples(parts, keys), keys, key_name)
    return store_buckets(lookup_key(parts, mapping, keys, [key_name], count_column=COUNT), table, buckets)
