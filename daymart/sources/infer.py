"""Types and time formats of text columns, found in one pass over all rows.

A column gets the narrowest type that every value of it fits: whole number,
number, truth value, day or time, else text. Nothing is decided from a part of
the rows. A day such as 03/04/2020 fits two layouts; a column whose values all
do is ambiguous, and its layouts are named instead of one being taken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.functions.convert import strict_cast
from daymart.functions.days import strict_timestamp

#: Layouts of a day, and of the time behind it.
DAY_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "MM-dd-yyyy")
TIME_LAYOUTS = ("", " HH:mm", " HH:mm:ss", "'T'HH:mm:ss")
_DIGITS = "0123456789"
_WHOLE = r"\A[+-]?(0|[1-9][0-9]{0,17})\z"
_NUMBER = r"\A[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_TYPE_NAMES = ("bigint", "double", "boolean")
FOUND = "column string, n_rows long, n_values long, type string, time_format string, candidates array<string>"


def time_formats() -> list[str]:
    return [day + time for day in DAY_LAYOUTS for time in TIME_LAYOUTS]


def _shape(layout: str) -> str:
    """A layout with 9 for each of its digits."""
    return "".join("9" if c in "yMdHms" else c for c in layout.replace("'", ""))


def _fits(text: Column, shape: Column, layout: str) -> Column:
    """Whether the text is a moment in this layout; only texts of its shape are parsed."""
    moment = F.try_to_timestamp(text, F.lit(layout))
    return F.when(shape == _shape(layout), moment.isNotNull()).otherwise(F.lit(False))


def _measures(name: str, formats: list[str]) -> Column:
    """Rows, values, and values that fit each type and layout, in that order."""
    # Empty text is no value, as in a file.
    text = F.when(F.col(f"`{name}`") != "", F.col(f"`{name}`"))
    shape = F.translate(text, _DIGITS, "9" * len(_DIGITS))
    tests = [
        text.isNotNull(),
        text.rlike(_WHOLE),
        text.rlike(_NUMBER),
        F.lower(text).isin("true", "false"),
        *(_fits(text, shape, layout) for layout in formats),
    ]
    return F.array(*(F.count_if(test) for test in tests))


def find_types(rows: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """One row for each column of ``rows``, whose columns are all text.

    ``type`` is bigint, double, boolean, date, timestamp or string, and
    ``time_format`` the one layout that all values fit. When several do,
    ``type`` is string and ``candidates`` names them. Whole numbers that begin
    with 0 are codes and numbers of more than 18 digits would not fit: the
    first stay text, the second are doubles. A column without values is text.

    One aggregate, summed in the tasks first; what remains is a row of counts.
    """
    formats = time_formats() if formats is None else formats
    others = [f.name for f in rows.schema if f.dataType.simpleString() != "string"]
    if others:
        raise ValueError(f"columns that are no text: {', '.join(others)}")
    names = rows.columns
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), *(_measures(n, formats).alias(f"c{k}") for k, n in enumerate(names)))
    each = F.inline(F.array(*(F.struct(F.lit(n).alias("column"), "n_rows", F.col(f"c{k}").alias("fit")) for k, n in enumerate(names))))
    long = counts.select(each)
    values = F.col("fit")[0]
    numbered = F.array(*(F.struct(F.lit(layout).alias("layout"), F.lit(4 + k).alias("at")) for k, layout in enumerate(formats)))
    fitting = F.filter(numbered, lambda x: (F.get("fit", x["at"]) == values) & (values > 0))
    long = long.withColumn("candidates", F.transform(fitting, lambda x: x["layout"])).withColumn("n_values", values)
    only = F.when(F.size("candidates") == 1, F.get("candidates", F.lit(0)))
    # Codes with leading zeros are numbers by their letters, and text all the same.
    plain = reduce(
        lambda rest, k: F.when(values == F.col("fit")[k], F.lit(_TYPE_NAMES[k - 1])).otherwise(rest),
        (3, 2, 1),
        F.when(only.isNull(), F.lit("string")).when(only.contains("H"), F.lit("timestamp")).otherwise(F.lit("date")),
    )
    kind = F.when(values == 0, F.lit("string")).otherwise(plain)
    shown = long.select("column", "n_rows", "n_values", kind.alias("type"), only.alias("time_format"), "candidates")
    return shown.to(shown.sparkSession.createDataFrame([], FOUND).schema)


def typed(rows: DataFrame, found: DataFrame, formats: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with the types found; ``formats`` gives the layout of columns by name.

    A column with several candidates and no layout given is refused by name. A
    value that does not fit its type fails and is shown. ``found`` has one row a
    column, so it may come to the driver.
    """
    formats = formats or {}
    kinds = {r["column"]: r for r in found.collect()}
    unclear = [n for n in rows.columns if len(kinds[n]["candidates"]) > 1 and n not in formats]
    if unclear:
        named = "; ".join(f"{n}: {', '.join(kinds[n]['candidates'])}" for n in unclear)
        raise ValueError(f"the time format is ambiguous, state one of these ({named})")
    return rows.select(*(_typed(n, kinds[n]["type"], formats.get(n, kinds[n]["time_format"])).alias(n) for n in rows.columns))


def _typed(name: str, kind: str, layout: str | None) -> Column:
    text = F.when(F.col(f"`{name}`") != "", F.col(f"`{name}`"))
    if layout is not None:
        read = strict_timestamp(text, layout)
        return read if "H" in layout else read.cast("date")
    return text if kind == "string" else strict_cast(text, kind)
