"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of the mix, but no more than its size
times the allowed epochs; what a capped source leaves is shared again by
weight among the others until none is above its cap. Within a source every
document is repeated as many whole times as the target holds the source, and
the rest of the target is taken in an order given by a seeded hash: whole
documents until it is used up, and the part of one document that is left.

The order is dealt out in hash buckets whose sizes are summed first, so a
source with a third of all rows is many small windows, never one.

Defined results: a null text has size 0; the null source is a source, last in
order; null and repeated doc_ids are documents like any other (ties in the
hash order go by doc_id, then size, then text; only rows that agree in all of
them share a bucket for sure); a very long text is one document; an empty table
gives no rows;
sources of size 0 have target 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.operators.lookup import broadcast_if_small
from daymart.operators.scratch import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
#: Least hexadecimal digits of a bucket, and the rows that it is meant for.
_BUCKET_DIGITS, _BUCKET_ROWS = 3, 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: str = "source") -> Column:
    """Text that tells the null source from every other; it sorts last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``source_key``, ``source_size`` and ``target`` for each source.

    ``sizes`` holds ``source_key`` and ``size`` by document. After the first
    aggregate there is one row a source, which is what the windows here see.
    """
    by_source = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy("source_key")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    everything = W.partitionBy()
    cap = F.col("source_size") * float(max_epochs)
    rows = by_source.select("*", weight.cast("double").alias("weight")).select(
        "*", cap.alias("cap"), (F.sum("source_size").over(everything) * F.lit(share)).alias("total")
    )
    # Sources whose cap is low for their weight are full first, so the capped
    # ones are a prefix of this order.
    order = W.orderBy(F.col("cap") / F.col("weight"), "source_key")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    later = order.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    capped = rows.select("*", (level * F.col("weight") > F.col("cap")).alias("capped"))
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    shared = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    fill = F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * (left / shared)))
    return capped.select("source_key", "source_size", fill.alias("target"))


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How often each document is taken.

    Returns doc_id, size, source_size, target and taken (words, repeats
    counted), and the columns named in ``keep``.
    """
    # Rows of one id are told apart by their texts, so an id that many rows
    # share is spread as well.
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), name, F.coalesce(F.md5("text"), F.lit("null"))))
    kept = [f"`{c}`" for c in keep]
    sized = settle(
        docs.select(
            "doc_id",
            _source_key().alias("source_key"),
            word_count(F.col("text")).alias("size"),
            order.alias("_order"),
            F.xxhash64("text").alias("_tie"),
            *kept,
        ),
        "sizes",
    )
    # A sixteenth for each digit: windows keep their size when the table grows.
    digits = max(_BUCKET_DIGITS, math.ceil(math.log(sized.count() / _BUCKET_ROWS + 1, 16)))
    sized = sized.withColumn("_bucket", F.substring("_order", 1, digits))
    fill = settle(targets(sized, weights, share, max_epochs), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    quota = F.floor("target") - F.col("whole") * F.col("source_size")
    plan = fill.select("*", whole.cast("long").alias("whole")).select("*", quota.cast("long").alias("quota"))

    buckets = sized.groupBy("source_key", "_bucket").agg(F.sum("size").alias("bucket_size"))
    before = W.partitionBy("source_key").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    started = buckets.select("source_key", "_bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("start"))
    in_bucket = W.partitionBy("source_key", "_bucket").orderBy("_order", "doc_id", "size", "_tie")
    earlier = in_bucket.rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("_earlier", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    joined = placed.join(started, ["source_key", "_bucket"]).join(broadcast_if_small(plan), "source_key")
    rest = F.greatest(F.lit(0), F.col("quota") - F.col("start") - F.col("_earlier"))
    taken = F.col("whole") * F.col("size") + F.least(F.col("size"), rest)
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *kept)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each repetition, the last one cut to its words.

    Documents without words are in no source's size and are left out of a mix.
    """
    columns = docs.columns
    # The row is kept as one value, so its columns may have any names.
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row")
    rows = mix(docs.select("doc_id", "text", "source", row), keep=("_row",), **options).filter(F.col("taken") > 0)
    repeats = F.sequence(F.lit(0).cast("long"), F.expr("(taken - 1) div size"))
    each = rows.select("size", "taken", "_row", F.explode(repeats).alias("_repeat"))
    words = F.least(F.col("size"), F.col("taken") - F.col("_repeat") * F.col("size")).cast("int")
    whole = words == F.col("size")
    old = F.col("_row.text")
    cut = F.array_join(F.slice(F.regexp_extract_all(old, F.lit(f"({WORD})"), F.lit(1)), F.lit(1), words), " ")
    new = {"text": F.when(whole, old).otherwise(cut)}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(whole, F.col("_row.n_chars")).otherwise(F.length(cut).cast(kind))
    return each.select(*(new[c].alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in columns))
