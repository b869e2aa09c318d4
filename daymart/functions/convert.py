"""Text tests and casts used while cleaning."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from daymart.schemas import NULL_TEXTS


def is_present(name: str) -> str:
    """SQL condition: column ``name`` is neither null nor a text for a missing value."""
    missing = ", ".join(f"'{text}'" for text in NULL_TEXTS)
    return f"(`{name}` IS NOT NULL AND `{name}` NOT IN ({missing}))"


def is_digits(text: Column) -> Column:
    """True when the whole text is ASCII digits (a trailing newline is not)."""
    return text.rlike(r"\A[0-9]+\z")


def or_raise(parsed: Column, text: Column, kind: str) -> Column:
    """``parsed``; an error naming the text when a non-null text did not parse."""
    message = F.concat(F.lit(f"cannot read as {kind}: "), text.cast("string"))
    return F.when(text.isNotNull(), F.coalesce(parsed, F.raise_error(message)))


def _casts_raise() -> bool:
    return SparkSession.active().conf.get("spark.sql.ansi.enabled") == "true"


def strict_cast(text: Column, type_name: str) -> Column:
    """Cast that fails on bad text whatever the session's ANSI setting is.

    An ANSI cast does so by itself, in less generated code: with a check of
    their own, the casts of one wide row outgrow the JIT compiler's limit.
    """
    if _casts_raise():
        return text.cast(type_name)
    return or_raise(text.try_cast(type_name), text, type_name)


def flag_to_boolean(flag: Column) -> Column:
    """1.0 -> true, 0.0 -> false, anything else -> null."""
    return F.when(flag == 1.0, True).when(flag == 0.0, False)
