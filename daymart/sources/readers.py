"""Scans. Every reader states its schema; none infers types from data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.convert import strict_cast
from daymart.functions.days import strict_timestamp
from daymart.sources.delimited import split_records
from daymart.sources.snapshots import read_snapshot
from daymart.schemas import CLEAN_EVENTS, SERIES, SERIES_DATE, SERIES_PAYLOAD

# A quote inside a quoted field is doubled, text keeps its outer spaces, and
# clock times are written plainly.
CSV_FORMAT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog")
#: Where temporary views are listed. No database can have such a name.
TEMPORARY = "(temporary)"
_MALFORMED = "_malformed"


def read_raw_events(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", multi_line: bool | None = None
) -> DataFrame:
    """Delimited text with a header line; every column stays text.

    Names and their order come from the header alone, and each file's header
    is checked against them, so files with another layout fail rather than
    shift their values. A row with fewer fields is filled up with nulls; one
    with more fails and is shown. Quoted fields may hold line breaks, in files
    of any size: see ``split_records``. ``multi_line`` says to read each file
    whole, by one task (True; the only way for other encodings), or that no
    file has such line breaks (False).
    """
    if multi_line is None and encoding.upper() in ("UTF-8", "UTF8"):
        return _from_records(spark, path, sep)
    options = {**CSV_FORMAT, "sep": sep, "encoding": encoding, "multiLine": multi_line is not False}
    names = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in names]
    marked = T.StructType([*fields, T.StructField(_MALFORMED, T.StringType())])
    # Every field is parsed, or a row's length could not be told.
    strict = {"columnNameOfCorruptRecord": _MALFORMED, "enforceSchema": False, "columnPruning": False}
    rows = spark.read.schema(marked).options(**options, **strict).csv(path)
    # A row is malformed when it is short or long; only a long one reaches
    # beyond the last column.
    beyond = _fields(F.col(_MALFORMED), len(names) + 1, sep)[f"f{len(names)}"]
    checked = F.when(F.col(_MALFORMED).isNotNull() & beyond.isNotNull(), _too_long(names, F.col(_MALFORMED))).otherwise(F.lit(True))
    return rows.filter(checked.cast("boolean")).drop(_MALFORMED)


def _fields(text: Column, count: int, sep: str) -> Column:
    """The first ``count`` fields f0, f1, ... of a record, as text."""
    names = ", ".join(f"f{k} string" for k in range(count))
    quiet = {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return F.from_csv(text, names, quiet)


def _too_long(names: list[str], text: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"a row has more than {len(names)} fields: "), text))


def _from_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    options = {**CSV_FORMAT, "sep": sep, "multiLine": True}
    names = spark.read.options(**options).csv(path).columns
    records = split_records(spark, path)
    # Checks name few columns: the optimizer would derive one over all of them
    # anew for every subset of columns that is renamed later.
    header = F.struct(*(F.lit(n.lower()).alias(f"f{k}") for k, n in enumerate(names)), F.lit(None).cast("string").alias(f"f{len(names)}"))
    as_named = _fields(F.lower("text"), len(names) + 1, sep).eqNullSafe(header)
    other = F.raise_error(F.concat(F.lit("a header is not that of the other files: "), "text", F.lit(" in "), "file"))
    is_row = F.when(~F.col("is_head"), F.lit(True)).when(as_named, F.lit(False)).otherwise(other)
    # A generator parses a record once, however many columns are taken from it.
    parsed = F.inline(F.array(_fields(F.col("text"), len(names) + 1, sep)))
    rows = records.filter(is_row.cast("boolean")).select("text", parsed)
    beyond = F.when(F.col(f"f{len(names)}").isNotNull(), _too_long(names, F.col("text"))).otherwise(F.lit(True))
    return rows.filter(beyond.cast("boolean")).select(*(F.col(f"f{k}").alias(n) for k, n in enumerate(names)))


def read_clean_events(spark: SparkSession, path: str, sep: str = ";", multi_line: bool | None = None) -> DataFrame:
    """Cleaned events written by ``write_csv``, with their types; files are read as by ``read_raw_events``."""
    if multi_line is not None:
        options = {**CSV_FORMAT, "sep": sep, "mode": "FAILFAST", "enforceSchema": False, "multiLine": multi_line}
        return spark.read.schema(CLEAN_EVENTS).options(**options).csv(path)
    raw = _from_records(spark, path, sep)
    if raw.columns != CLEAN_EVENTS.names:
        raise ValueError(f"the columns of {path} are not those of cleaned events: {', '.join(raw.columns)}")

    def typed(field: T.StructField) -> Column:
        text = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return text
        if isinstance(field.dataType, T.TimestampNTZType):
            return strict_timestamp(text, CSV_FORMAT["timestampNTZFormat"]).alias(field.name)
        return strict_cast(text, field.dataType.simpleString()).alias(field.name)

    return raw.select(*map(typed, CLEAN_EVENTS.fields))


def read_series_payload(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents of parallel arrays, one document per file."""
    return spark.read.schema(SERIES_PAYLOAD).options(multiLine=True, mode="FAILFAST").json(path)


def read_series(
    spark: SparkSession, path: str, file_format: str = "parquet", version: int | None = None
) -> DataFrame:
    """Stored daily series, its newest snapshot or that of ``version``; bookkeeping fields (``_id``, ``loaded_at``) are not read.

    Text that is no document of the series, or a day or value that cannot be
    read, fails the job rather than become null, and so does a document
    without a day: its events would be lost in silence.
    """
    if file_format == "parquet":
        return read_snapshot(spark, path, version, SERIES)
    if version is not None:
        raise ValueError("only stored series have versions")
    if file_format != "json":
        return spark.read.schema(SERIES).format(file_format).load(path)
    rows = spark.read.schema(SERIES).options(mode="FAILFAST", dateFormat="yyyy-MM-dd").json(path)
    missing = F.raise_error(F.lit("a document of the series has no day"))
    return rows.filter(F.when(F.col(SERIES_DATE).isNull(), missing).otherwise(F.lit(True)).cast("boolean"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``save_table``."""
    return spark.read.parquet(path)


def list_tables(spark: SparkSession) -> dict[tuple[str, str], DataFrame]:
    """(schema, name) -> frame for every table and view but the system's.

    Temporary views belong to no schema: they are listed under ``TEMPORARY``,
    global ones under the name of their own database.
    """
    found = {}
    for database in spark.catalog.listDatabases():
        if database.name in SYSTEM_SCHEMAS:
            continue
        for table in spark.catalog.listTables(database.name):
            if table.isTemporary:
                found[(TEMPORARY, table.name)] = spark.table(f"`{table.name}`")
            else:
                found[(database.name, table.name)] = spark.table(f"`{database.name}`.`{table.name}`")
    shared = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    for table in spark.catalog.listTables(shared):
        if table.namespace == [shared]:
            found[(shared, table.name)] = spark.table(f"`{shared}`.`{table.name}`")
    return found
