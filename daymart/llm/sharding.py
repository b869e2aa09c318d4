"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

A shard stands on the ring at many places. A key belongs to the first shard
clockwise of its own place that still has room; a full shard sends keys on. No
shard takes more than its bound, and as the bounds add up to little more than
the whole, no shard can stay far below either. When a shard is added, keys
move to it and along the ring behind it, most stay.

Keys are groups of equal texts. They are summed in a fixed number of ring
cells before anything is placed, and cells are what the driver places: their
number does not grow with the table. A group above a hundredth of a shard is
cut into cells of its own by document id, so copies fill shards in turn rather
than outweigh one.

Defined results: a null text has size 8 (its fixed part) and the checksum of
no bytes, and is a group of its own; null doc_ids are kept; rows with one
doc_id and text are rows of their own; a very long text is one row, and its
shard is above the bound by no more than it; an empty table gives no rows. The law is ``bytes``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.operators.scratch import settle

SHARDS = 24
VIRTUAL_NODES = 512
#: What a shard may hold above the mean.
SLACK = 0.002
ROW_BYTES = 8
_CELL_BITS = 16
#: A group above this part of a shard is cut, in pieces of a sixteenth of it.
_HOT_PART = 0.01
_PIECES = 16


def _place(*names: object) -> int:
    text = ":".join(map(str, names)).encode()
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big")


def place_cells(
    cells: list[tuple[int, int, int]], shards: int, virtual_nodes: int = VIRTUAL_NODES, slack: float = SLACK
) -> dict[int, int]:
    """Shard of each cell; ``cells`` holds (cell, place on the ring, bytes).

    Cells come in an order that a hash gives, so which keys a full shard sends
    on does not follow the ring.
    """
    nodes = sorted((_place("node", s, v), s) for s in range(shards) for v in range(virtual_nodes))
    places, owners = [p for p, _ in nodes], [s for _, s in nodes]
    total = sum(size for _, _, size in cells)
    bound = max(total * (1 + slack) / shards, total / shards + max((size for _, _, size in cells), default=0) / 2)
    loads = [0] * shards
    out = {}
    for cell, place, size in sorted(cells, key=lambda c: _place("cell", c[0])):
        start = bisect_left(places, place) % len(nodes)
        for step in range(len(nodes)):
            shard = owners[(start + step) % len(nodes)]
            if loads[shard] + size <= bound:
                break
        else:
            # No shard has room for a cell this large: the emptiest takes it.
            shard = min(range(shards), key=lambda s: (loads[s], s))
        loads[shard] += size
        out[cell] = shard
    return out


def assign_shards(
    rows: DataFrame, *, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, slack: float = SLACK
) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows with doc_id, size, text_crc32 and group.

    ``group`` is a 64-bit hash of the text, ``size`` the row's bytes.
    ``rows`` must be a stored table; it is read three times, and places in its
    files are the same each time.
    """
    spark = rows.sparkSession
    rows = rows.select("*", F.xxhash64("doc_id", "_metadata.row_index").alias("_spread"))
    cell = F.pmod(F.col("group"), F.lit(1 << _CELL_BITS))
    rows = rows.withColumn("_cell", cell)
    by_cell = rows.groupBy("_cell").agg(F.sum("size").alias("bytes"))
    total = by_cell.agg(F.sum("bytes")).first()[0] or 0
    limit = max(1, int(total / shards * _HOT_PART))
    # Only a heavy cell can hold a heavy group, and 1 / _HOT_PART times the
    # shards are the most that there can be of either.
    heavy = by_cell.filter(F.col("bytes") > limit).select("_cell")
    groups = rows.join(F.broadcast(heavy), "_cell").groupBy("group").agg(F.sum("size").alias("bytes"))
    hot = sorted((r["group"], r["bytes"]) for r in groups.filter(F.col("bytes") > limit).collect())
    firsts, first = [], 1 << _CELL_BITS
    for group, size in hot:
        pieces = -(-size * _PIECES // limit)
        firsts.append((group, first, pieces))
        first += pieces
    table = spark.createDataFrame(firsts, "group long, first long, pieces long")
    piece = F.col("first") + F.pmod(F.col("_spread"), F.col("pieces"))
    rows = rows.join(F.broadcast(table), "group", "left").withColumn("_cell", F.coalesce(piece, "_cell"))

    # At most 2 ** _CELL_BITS cells and _PIECES / _HOT_PART * shards pieces.
    found = rows.groupBy("_cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    at = {f: g % (1 << _CELL_BITS) for g, a, n in firsts for f in range(a, a + n)}
    cells = [(r["_cell"], at.get(r["_cell"], r["_cell"]) << (64 - _CELL_BITS), r["bytes"]) for r in found]
    shard_of = place_cells(cells, shards, virtual_nodes, slack)
    start = [0] * shards
    placed = []
    for r in sorted(found, key=lambda r: r["_cell"]):
        shard = shard_of[r["_cell"]]
        placed.append((r["_cell"], shard, start[shard]))
        start[shard] += r["rows"]
    where = spark.createDataFrame(placed, "_cell long, shard int, _start long")
    turn = F.row_number().over(W.partitionBy("_cell").orderBy("doc_id", "text_crc32", "size"))
    numbered = rows.withColumn("_turn", turn).join(F.broadcast(where), "_cell")
    slot = (F.col("_start") + F.col("_turn") - 1).alias("slot")
    return numbered.drop("first", "pieces", "_spread").select("*", slot).drop("_cell", "_turn", "_start")


def shard_documents(docs: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    text = F.coalesce("text", F.lit(""))
    rows = settle(
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64("text").alias("group"),
        ),
        "keys",
    )
    placed = assign_shards(rows, shards=shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
