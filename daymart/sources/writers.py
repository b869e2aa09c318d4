"""Sinks. A rerun replaces what an earlier run wrote unless told to append."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.operators.series import keyed_replace
from daymart.schemas import SERIES
from daymart.sources.digests import digest_columns, table_digest
from daymart.sources.readers import CSV_FORMAT
from daymart.sources.snapshots import append_snapshot, commit, read_snapshot, write_data

EXPORT_PREFIX = "main_"
STORED_SERIES = T.StructType([*SERIES.fields, T.StructField("loaded_at", T.TimestampNTZType())])


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """Delimited text with a header and no row index, replacing ``path``."""
    df.write.mode("overwrite").options(**CSV_FORMAT, sep=sep).csv(path)


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the Parquet table at ``path``.

    With ``partition_by``, rows of one value meet in few tasks first, so the
    folders do not fill with small files; adaptive execution splits a value
    that holds too many rows for one task.
    """
    if partition_by:
        gathered = df.hint("rebalance", *map(F.col, partition_by))
        gathered.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def save_series(new: DataFrame, path: str, loaded_at: datetime, mode: str = "replace") -> None:
    """Add a load of the daily series to the stored one.

    ``replace`` keeps one row per day, the newest load's. ``append`` adds the
    rows as they are, so days loaded twice are stored twice. Either is one
    commit: readers see all of a load or none (see ``snapshots``).
    """
    stamped = new.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz")).select(*STORED_SERIES.names)
    spark = new.sparkSession
    if mode == "append":
        append_snapshot(stamped, path)
    elif mode == "replace":

        def merged(newest: int | None, _: list[str]) -> list[str]:
            loads = stamped
            if newest is not None:
                loads = read_snapshot(spark, path, newest, STORED_SERIES).unionByName(stamped)
            return [write_data(keyed_replace(loads), path)]

        commit(spark, path, merged)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def publish_model(
    df: DataFrame, name: str, kind: str = "table", path: str | None = None, schema: str | None = None
) -> DataFrame:
    """Give a model a name: a view of its plan, or a stored table.

    With ``schema`` a table is one of the catalog, made with its schema if need
    be, and replaced by a rerun; it outlives the session where the catalog
    does. Without one it is stored at ``path`` under a name of this session.
    A view always belongs to the session.
    """
    spark = df.sparkSession
    if kind == "table" and schema is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        writer = df.write.mode("overwrite").format("parquet")
        (writer if path is None else writer.option("path", path)).saveAsTable(f"`{schema}`.`{name}`")
        return spark.table(f"`{schema}`.`{name}`")
    if kind == "table":
        if path is None:
            raise ValueError("a table needs a path or a schema")
        save_table(df, path)
        df = spark.read.schema(df.schema).parquet(path)
    elif kind != "view":
        raise ValueError(f"unknown kind {kind!r}")
    elif schema is not None:
        raise ValueError("a view belongs to no schema")
    df.createOrReplaceTempView(name)
    return df


def export_name(table: str) -> str:
    """Flat name of an exported table.

    A name that starts with ``main_`` loses that text wherever it occurs;
    any other name stays.
    """
    return table.replace(EXPORT_PREFIX, "") if table.startswith(EXPORT_PREFIX) else table


def check_export_names(names: Iterable[str]) -> None:
    """Fail when two tables would be written to one place."""
    twice = sorted(name for name, uses in Counter(names).items() if uses > 1)
    if twice:
        raise ValueError(f"several tables would be exported as: {', '.join(twice)}")


def export_parquet(tables: dict[tuple[str, str], DataFrame], base: str) -> list[str]:
    """Write each (schema, name) table to ``base/<flat name>.parquet``.

    Rows and a digest of all columns are gathered while a table is written and
    compared with what is read back; a copy that differs fails.
    """
    check_export_names(export_name(name) for _, name in tables)
    written = []
    for (schema, name), df in tables.items():
        path = f"{base.rstrip('/')}/{export_name(name)}.parquet"
        sent = Observation()
        df.observe(sent, *digest_columns(df)).write.mode("overwrite").parquet(path)
        wanted = sent.get["rows"], int(sent.get["digest"])
        found = table_digest(df.sparkSession.read.schema(df.schema).parquet(path))
        if found != wanted:
            raise RuntimeError(f"{schema}.{name} was sent with rows and digest {wanted}, but {path} has {found}")
        written.append(path)
    return written


def relational_name(schema: str, table: str) -> str:
    return f"{schema}_{table}"


def relational_options(url: str, table: str, writers: int, batch_rows: int) -> dict[str, str]:
    """JDBC writer options; ``writers`` bounds the open connections."""
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(writers),
        "batchsize": str(batch_rows),
        "truncate": "true",
    }


def export_relational(
    tables: dict[tuple[str, str], DataFrame],
    url: str,
    properties: dict[str, str],
    mode: str = "overwrite",
    writers: int = 8,
    batch_rows: int = 10_000,
) -> None:
    """Copy each (schema, name) table to ``<schema>_<name>`` over JDBC.

    The dialect maps bigint, string, double, date and boolean. ``overwrite``
    empties and refills a table, so a rerun leaves no duplicates; ``append``
    adds to a table that is there. Each partition commits on its own, and a commit whose success
    an executor could not report is repeated; the row counts are compared
    afterwards to catch that.
    """
    check_export_names(relational_name(*key) for key in tables)
    for (schema, name), df in tables.items():
        target = relational_name(schema, name)
        spark = df.sparkSession
        options = {**properties, **relational_options(url, target, writers, batch_rows)}

        counted = {**properties, "url": url, "query": f"SELECT count(*) AS n FROM {target}"}

        def stored() -> int:
            return int(spark.read.format("jdbc").options(**counted).load().first()[0])

        before = stored() if mode == "append" else 0
        # The rows are counted while they are sent: the plan runs once.
        sent = Observation()
        observed = df.observe(sent, F.count(F.lit(1)).alias("rows"))
        observed.write.format("jdbc").mode(mode).options(**options).save()
        added = stored() - before
        if added != sent.get["rows"]:
            raise RuntimeError(f"{target} has {added} new rows after the export of {sent.get['rows']}")
