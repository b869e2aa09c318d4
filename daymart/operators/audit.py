"""Cleaning that accounts for every row: what is kept, what is not, and why.

Each raw row gets a mask of the rules it breaks. All rows are written in one
pass, kept and rejected ones in folders of their own, and counted while they
are written; the counts are compared with what the folders hold. A text that
cannot be read is a broken rule here, where ``clean_events`` fails.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.convert import is_digits, is_present
from daymart.operators.clean import clean_events
from daymart.schemas import (
    ALLOWED_REGIONS,
    ALLOWED_SETTLEMENTS,
    CASE_NUMBER,
    CLEAN_EVENTS,
    KEPT_COLUMNS,
    REGION,
    SETTLEMENT,
)

#: Rule n is bit n of the mask.
RULES = ("missing", "case_number", "unreadable", "region", "settlement")
FAILED, KEPT = "failed_rules", "kept"


def broken_rules(
    time_format: str, regions: list[str] = ALLOWED_REGIONS, settlements: list[str] = ALLOWED_SETTLEMENTS
) -> dict[str, Column]:
    """Whether a raw row breaks each rule. A value that is missing breaks no rule but that one."""
    present = {name: F.expr(is_present(name)) for name in KEPT_COLUMNS}

    def unread(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        is_time = isinstance(field.dataType, T.TimestampNTZType)
        read = F.try_to_timestamp(text, F.lit(time_format)) if is_time else text.try_cast(field.dataType)
        return present[field.name] & read.isNull()

    typed = [f for f in CLEAN_EVENTS.fields if not isinstance(f.dataType, T.StringType) and f.name != CASE_NUMBER]
    case = F.col(f"`{CASE_NUMBER}`")
    # Digits that no number holds are no case number either.
    kind = next(f.dataType for f in CLEAN_EVENTS.fields if f.name == CASE_NUMBER)
    number = is_digits(case) & case.try_cast(kind).isNotNull()
    return {
        "missing": ~reduce(and_, present.values()),
        "case_number": present[CASE_NUMBER] & ~number,
        "unreadable": reduce(or_, map(unread, typed)),
        "region": present[REGION] & ~F.col(f"`{REGION}`").isin(regions),
        "settlement": present[SETTLEMENT] & ~F.col(f"`{SETTLEMENT}`").isin(settlements),
    }


def audit_events(raw: DataFrame, path: str, time_format: str, **allowed: list[str]) -> dict[str, int]:
    """Store raw events with the mask of rules they break; how many were read, kept, rejected, and broke each rule.

    ``raw`` is read once. A missing kept column is an error. The counts are
    those of the write; a stored table that holds other rows is refused.
    """
    broken = broken_rules(time_format, **allowed)
    bits = (F.when(broken[rule], F.lit(1 << k)).otherwise(0) for k, rule in enumerate(RULES))
    judged = raw.select(*(f"`{c}`" for c in KEPT_COLUMNS), reduce(lambda a, b: a + b, bits).alias(FAILED))
    counts = Observation()
    sums = [F.count(F.lit(1)).alias("read"), F.count(F.when(F.col(FAILED) == 0, 1)).alias("kept")]
    sums += [F.count(F.when(F.col(FAILED).bitwiseAND(1 << k) > 0, 1)).alias(rule) for k, rule in enumerate(RULES)]
    judged.observe(counts, *sums).withColumn(KEPT, F.col(FAILED) == 0).write.mode("overwrite").partitionBy(KEPT).parquet(path)
    found = counts.get
    found["rejected"] = found["read"] - found["kept"]
    stored = _stored(raw.sparkSession, path).groupBy(KEPT).count().collect()
    held = {row[KEPT]: row["count"] for row in stored}
    if (held.get(True, 0), held.get(False, 0)) != (found["kept"], found["rejected"]):
        raise RuntimeError(f"{path} holds {held}, but {found['kept']} rows were kept and {found['rejected']} rejected")
    return found


def _stored(spark: SparkSession, path: str) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in KEPT_COLUMNS]
    schema = T.StructType([*fields, T.StructField(FAILED, T.IntegerType()), T.StructField(KEPT, T.BooleanType())])
    return spark.read.schema(schema).parquet(path)


def read_kept(spark: SparkSession, path: str, time_format: str) -> DataFrame:
    """Typed events that broke no rule."""
    return clean_events(_stored(spark, path).filter(KEPT).select(*(f"`{c}`" for c in KEPT_COLUMNS)), time_format)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows that broke a rule, with the names of all they broke."""
    names = F.filter(F.array(*(F.when(F.col(FAILED).bitwiseAND(1 << k) > 0, F.lit(rule)) for k, rule in enumerate(RULES))), lambda r: r.isNotNull())
    return _stored(spark, path).filter(~F.col(KEPT)).drop(KEPT).withColumn("rules", names)
