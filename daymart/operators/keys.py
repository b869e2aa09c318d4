"""Dense surrogate keys, ``1..n`` in sort order, without a one-task window.

``row_number() OVER (ORDER BY ...)`` moves every row to one task. Here each
distinct tuple is counted first (so copies collapse before the shuffle), the
tuples are range-partitioned and sorted, and a key is the tuple's place in
its partition plus the rows in the partitions before it. Partition and place
are written down once, so both passes see the same numbers whatever is
recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.operators.scratch import settle

COUNT = "_rows"
_PART, _PLACE, _START = "_part", "_place", "_start"
_ROWS_PER_TASK = 2_000_000
_MOST_TASKS = 20_000
_CHUNK = 65_536
_BLOCK, _BLOCK_ROWS = "_block", 1 << 20


def rank_tuples(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Distinct ``keys`` tuples with their row count, partition and place; stored.

    Nulls sort last.
    """
    order = [F.col(k).asc_nulls_last() for k in keys]
    # Stored once counted: dealing by ranges reads them twice, and their number
    # says how many ranges they need, whatever the session's default is.
    tuples = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT)), "tuples")
    if partitions is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-tuples.count() // _ROWS_PER_TASK))
    ranged = tuples.repartitionByRange(partitions, *order)
    place_bits = F.lit((1 << 33) - 1)
    placed = ranged.sortWithinPartitions(*order).select(
        *keys,
        COUNT,
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().bitwiseAND(place_bits).alias(_PLACE),
    )
    return settle(placed, "ranked")


def _with_offsets(ranked: DataFrame, amount, pieces: list[str] | None = None) -> DataFrame:
    """Add ``_start``: the sum of ``amount`` over all earlier pieces.

    The offsets have one row per piece (a range partition by default, or a
    block of a million rows of one), so the window over them is bounded by the
    number of pieces; they are broadcast when they are small.
    """
    pieces = pieces or [_PART]
    sums = ranked.groupBy(*pieces).agg(amount.alias("_amount"))
    before = W.orderBy(*pieces).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*pieces, F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias(_START))
    return ranked.join(F.broadcast(offsets), pieces)


def dense_keys(ranked: DataFrame, keys: list[str], key_name: str) -> DataFrame:
    """One row per tuple: its key, the tuple, and its row count."""
    numbered = _with_offsets(ranked, F.count(F.lit(1)))
    return numbered.select((F.col(_START) + F.col(_PLACE) + 1).alias(key_name), *keys, COUNT)


def expand_rows(ranked: DataFrame, keys: list[str], key_name: str) -> DataFrame:
    """One row per counted row, each with a key of its own, ties adjacent.

    A tuple that stands for very many rows is cut in chunks and the chunks are
    spread before they are unrolled, so no task unrolls a hot tuple alone.
    """
    # Places are summed in blocks: the window of a task is one block, and the
    # blocks' own sums are few.
    blocks = ranked.withColumn(_BLOCK, F.expr(f"{_PLACE} div {_BLOCK_ROWS}"))
    earlier = W.partitionBy(_PART, _BLOCK).orderBy(_PLACE).rowsBetween(W.unboundedPreceding, -1)
    first = F.col(_START) + F.coalesce(F.sum(COUNT).over(earlier), F.lit(0))
    started = _with_offsets(blocks, F.sum(COUNT), [_PART, _BLOCK]).select(*keys, COUNT, first.alias("_first"))

    last_chunk = F.expr(f"({COUNT} - 1) div {_CHUNK}")
    chunks = started.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_chunk"))
    total = ranked.agg(F.sum(COUNT).alias("total")).first()["total"] or 0
    # A stated partition count: adaptive execution would judge the chunks by
    # their size before unrolling and merge them.
    spread = chunks.repartition(min(_MOST_TASKS, max(1, -(-total // _ROWS_PER_TASK))), "_first", "_chunk")

    done = F.col("_chunk") * _CHUNK
    offset = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(_CHUNK), F.col(COUNT) - done)))
    unrolled = spread.select("*", offset.alias("_offset"))
    return unrolled.select((F.col("_first") + done + F.col("_offset")).alias(key_name), *keys)
