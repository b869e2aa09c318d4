"""Packing by powers of two: no sequence holds parts of two documents.

A document of n tokens is cut into the binary places of n: as many pieces of
the longest length as fit, then one piece for each further binary digit, long
ones first. A piece is a sequence of its own; its length is a power of two, so
it needs no padding, and sequences of one length are numbered together, ready
to be batched by length.

Defined results: a null text is the empty document, which is its end token
alone; a null doc_id is kept; rows of one id, and equal rows, are documents of
their own; a very long text is encoded whole by one task and cut like any
other; an empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.llm.tokens import ID_TYPE, encode_texts, encoder
from daymart.operators.scratch import settle

MAX_TOKENS = 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Texts that Spark hands to a worker at once, and bytes of ids that it hands back.
_TEXTS_AT_ONCE = 2000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_IDS_AT_ONCE = 4 << 20


def binary_lengths(n: int, longest: int = MAX_TOKENS) -> list[int]:
    """Lengths, longest first, of the pieces of ``n`` tokens."""
    lengths = [longest] * (n // longest)
    rest = n % longest
    return lengths + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(
    docs: DataFrame,
    *,
    tokenizer: str,
    spaced: bool,
    end_id: int,
    longest: int = MAX_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece, with its ids or without; a map over the documents."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer, spaced)
        end = np.array([end_id], dtype=ID_TYPE).tobytes()
        for frame in frames:
            rows = []
            held = 0
            texts = encode_texts(words, frame["text"].tolist())
            for doc_id, ids in zip(frame["doc_id"], texts):
                ids += end
                n, start = len(ids) // 4, 0
                for length in binary_lengths(n, longest):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(part), n)
                    rows.append((*row, part) if with_ids else row)
                    start += length
                held += len(ids)
                if held > _IDS_AT_ONCE:
                    yield _frame(rows, with_ids)
                    rows, held = [], 0
            yield _frame(rows, with_ids)

    return docs.select("doc_id", "text").mapInPandas(cut, f"{PIECES}, ids binary" if with_ids else PIECES)


def _frame(rows: list[tuple], with_ids: bool) -> pd.DataFrame:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    frame = pd.DataFrame(rows, columns=[*names, "ids"] if with_ids else names)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame


def number_sequences(cut: DataFrame, *others: str) -> DataFrame:
    """Number the pieces 0, 1, ... with equal lengths together, longest first.

    Pieces are first counted by (length, part), where a part is a share of the
    documents by hash; the counts are few and bounded, so the one task that
    sums them does not grow with the table. Places in a part are numbered by
    the tasks that hold them. ``cut`` must be stored: it is read twice.
    """
    rows = cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *others)
    total = rows.count()
    parts = min(1 << 16, total // 20_000 + 1)
    # A document that is repeated very often is spread by its pieces as well.
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts))
    rows = rows.withColumn("part", part)
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy(F.desc("length"), "part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    numbered = rows.withColumn("place", place).join(F.broadcast(bases), ["length", "part"])
    return numbered.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("base") + F.col("place") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *others,
    )


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    spaced: bool,
    end_id: int,
    longest: int = MAX_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Packed sequences; ``with_ids`` adds their tokens as little-endian uint32."""
    others = ["ids"] if with_ids else []
    cut = pieces(docs, tokenizer=tokenizer, spaced=spaced, end_id=end_id, longest=longest, with_ids=with_ids)
    with _small_batches(docs.sparkSession):
        stored = settle(cut, "pieces")
    return number_sequences(stored, *others)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """While a frame is written: texts go to workers in batches that take little memory on either side."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, min(_TEXTS_AT_ONCE, int(before)) if int(before) > 0 else _TEXTS_AT_ONCE)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)
