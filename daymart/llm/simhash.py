"""Near-duplicates by SimHash and a hierarchical index in Gray order.

A fingerprint bit is set when more than half of a text's shingle hashes have
it. Equal fingerprints are one node. Nodes that may be linked are brought
together by routing keys, and a task links the nodes of one key with the index
below.

The index sorts fingerprints by their rank in the Gray code, in which
neighbours differ in one bit, so near ones gather. Leaves of consecutive
fingerprints keep the bits that all their members share as a mask and a
pattern; upper nodes keep what is shared by their leaves. A search adds up the
differences to the patterns on the way down and leaves a whole group out when
they pass the limit.

Two fingerprints of 64 bits that are at most 3 bits apart agree on one of four
blocks of 16, so no link is lost when each block routes by itself. A key is the
leading bits of a block, as many as leave about a thousand nodes under it, and
the index of a key has that block in front: fingerprints that agree on it are
neighbours in Gray order. A key with very many nodes is dealt out again by
further bits; what is still crowded after that is cut into blocks of which each
pair meets by itself, so no task takes a group that grows with the table.

Defined results: texts without words have fingerprint zero and are linked like
any other; null texts are empty; a null doc_id is kept, and never the smallest
id of a component unless all its ids are null; repeated rows are in one
component; very long texts are fingerprinted whole, by the task that holds
them; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.llm.components import components
from daymart.llm.tokens import small_batches
from daymart.operators.lookup import broadcast_if_small
from daymart.operators.scratch import settle

SEED = 42
BITS = 64
MAX_DISTANCE = 3
#: Nodes of one key of the first level, in the mean: enough for the index to have levels.
INDEXED_NODES = 1024
#: Nodes of one key that a task takes; more are dealt out by further bits, or in pairs of blocks.
GROUP_NODES = 4096
_SHINGLES_AT_ONCE = 1 << 17
_LEAF, _FAN = 32, 8
_PAIRS_AT_ONCE = 1 << 18
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MIX = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; fewer words are one shingle."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - shingle] + 1]).tolist()
    parts = [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype=np.uint64, count=len(parts))


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Further hashes of a shingle, from its first one."""
    if k == 0:
        return hashes
    x = hashes + np.uint64(_MIX * k & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[a : a + _SHINGLES_AT_ONCE].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Blocks of 255 rows are summed in bytes, which is what is fast.
        full = len(bits) // 255 * 255
        if full:
            counts += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[full:].sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(hashes))


def fingerprint(text: str | None, shingle: int, bits: int = BITS) -> bytes:
    """Big-endian fingerprint of ``bits`` (a multiple of 64) bits."""
    return _mark(shingle_hashes(text, shingle), bits)


def _mark(hashes: np.ndarray, bits: int) -> bytes:
    return b"".join(_majority(_mixed(hashes, k)).to_bytes(8, "big") for k in range(bits // 64))


def fingerprints(docs: DataFrame, shingle: int, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (binary) and text_hash of each row."""

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, "text"):
            out = frame[["doc_id", "text_hash"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out.assign(fingerprint=[fingerprint(t, shingle, bits) for t in frame["text"]])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInPandas(mark, "doc_id long, text_hash long, fingerprint binary")


def block_first(codes: np.ndarray, block: int) -> np.ndarray:
    """Codes turned so that a block of 16 bits leads, and those that agree on it are neighbours."""
    turn = np.uint64(16 * (3 - block))
    return codes if not turn else (codes << turn) | (codes >> (np.uint64(64) - turn))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Rank of each 64-bit code in the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints (n, words of 64 bits) in Gray order, with nodes above them."""

    def __init__(self, codes: np.ndarray):
        ranks = [gray_rank(codes[:, w]) for w in range(codes.shape[1] - 1, -1, -1)]
        self.order = np.lexsort(ranks)
        self.codes = codes[self.order]
        self.levels = []
        low, high = self.codes, self.codes
        fan = _LEAF
        while True:
            starts = np.arange(0, len(low), fan)
            low = np.bitwise_and.reduceat(low, starts, axis=0)
            high = np.bitwise_or.reduceat(high, starts, axis=0)
            # Bits that are set in all members or in none are shared.
            self.levels.append((~(low ^ high), low, fan))
            if len(starts) <= _FAN:
                break
            fan = _FAN

    def near(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, place in Gray order) at most ``limit`` bits apart."""
        mask, pattern, _ = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(mask))
        node = np.tile(np.arange(len(mask)), len(queries))
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern, fan = self.levels[level]
            keep = _bits((queries[q] ^ pattern[node]) & mask[node]) <= limit
            q, node = q[keep], node[keep]
            below = len(self.levels[level - 1][0]) if level else len(self.codes)
            q = np.repeat(q, fan)
            node = (node[:, None] * fan + np.arange(fan)).ravel()
            inside = node < below
            q, node = q[inside], node[inside]
        keep = _bits(queries[q] ^ self.codes[node]) <= limit
        return q[keep], node[keep]


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=1, dtype=np.int32)


def _follow(labels: np.ndarray) -> np.ndarray:
    while True:
        further = labels[labels]
        if np.array_equal(further, labels):
            return labels
        labels = further


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray, out: list) -> np.ndarray:
    """Join the sets of ``a`` and ``b``; pairs that joined two sets go to ``out``."""
    while True:
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return labels
        a, b = a[open_], b[open_]
        high, low = np.maximum(la[open_], lb[open_]), np.minimum(la[open_], lb[open_])
        # Each set hooks on to one lower set at a time, so pairs form a forest.
        hooked, first = np.unique(high, return_index=True)
        out.append((a[first], b[first]))
        labels = labels.copy()
        labels[hooked] = low[first]
        labels = _follow(labels)


def link_group(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of linked pairs that joins what ``limit`` joins among ``codes``.

    Of the links between two sets the nearest is taken, within what is looked
    at at once.
    """
    index = GrayIndex(codes)
    n = len(codes)
    labels, pairs = np.arange(n), []
    step = max(1, _PAIRS_AT_ONCE // n)
    for a in range(0, n, step):
        # Later places only: each pair is met once.
        q, place = index.near(index.codes[a : a + step], limit)
        q = q + a
        later = place > q
        q, place = q[later], place[later]
        open_ = labels[q] != labels[place]
        q, place = q[open_], place[open_]
        apart = _bits(index.codes[q] ^ index.codes[place])
        for d in np.unique(apart):
            labels = _join(labels, q[apart == d], place[apart == d], pairs)
    if not pairs:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    a, b = (np.concatenate(side) for side in zip(*pairs))
    return index.order[a], index.order[b]


@dataclass(frozen=True)
class Exact:
    """Blocks of 64 bits: four of 16, of which leading bits route, then the other blocks in four again."""

    limit: int = MAX_DISTANCE
    levels: int = 3
    leading: int = 16

    @staticmethod
    def for_nodes(count: int) -> Exact:
        """As many leading bits that a key holds ``INDEXED_NODES`` nodes in the mean."""
        return Exact(leading=min(16, max(0, math.ceil(math.log2(max(1, count) / INDEXED_NODES)))))

    def _rest(self, path: tuple[int, ...]) -> list[int]:
        bits = list(range(64))
        for k in path:
            block = self._blocks(bits)[k]
            bits = [b for b in bits if b not in block]
        return bits

    def _blocks(self, bits: list[int]) -> list[list[int]]:
        n, parts = len(bits), self.limit + 1
        return [bits[n * k // parts : n * (k + 1) // parts] for k in range(parts)]

    def tables(self, path: tuple[int, ...]) -> list[list[int]]:
        """Bits of the keys that follow a path. Of a first block its highest bits are enough to route."""
        blocks = self._blocks(self._rest(path))
        return blocks if path else [block[len(block) - self.leading :] for block in blocks]


def _codes(marks: pd.Series) -> np.ndarray:
    """(n, words) codes from big-endian bytes."""
    data = np.frombuffer(b"".join(marks), dtype=">u8").astype(np.uint64)
    return data.reshape(len(marks), -1)


def _keys(codes: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(codes), dtype=np.uint64)
    for b in bits:
        out = (out << np.uint64(1)) | ((codes[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1))
    return out


ROUTED = "path string, key long, node long, fingerprint binary"


def _route(rows: DataFrame, scheme: Exact) -> DataFrame:
    """Each row in every table of its path; ``key`` grows by the table's bits."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, part in frame.groupby("path", sort=False):
                steps = tuple(int(x) for x in path.split("/") if x)
                codes = _codes(part["fingerprint"])
                held = part["key"].to_numpy(dtype=np.int64).view(np.uint64)
                for k, bits in enumerate(scheme.tables(steps)):
                    key = _mixed(held * np.uint64(31) + _keys(codes, bits), 1).view(np.int64)
                    yield part[["node", "fingerprint"]].assign(path=f"{path}/{k}", key=key)[["path", "key", "node", "fingerprint"]]

    return rows.mapInPandas(deal, ROUTED)


def _link(routed: DataFrame, limit: int, partitions: int) -> DataFrame:
    """Linked pairs of nodes (a, b), a forest for each key."""
    dealt = routed.repartition(partitions, "path", "key").sortWithinPartitions("path", "key")

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            # The last key of a frame may go on in the next one.
            last = ((frame["path"] == frame["path"].iloc[-1]) & (frame["key"] == frame["key"].iloc[-1])).to_numpy()
            whole = frame[~last]
            held = frame[last]
            yield _link_frame(whole, limit)
        if held is not None:
            yield _link_frame(held, limit)

    return dealt.mapInPandas(link, "a long, b long")


def _link_frame(frame: pd.DataFrame, limit: int) -> pd.DataFrame:
    nodes = frame["node"].to_numpy(dtype=np.int64)
    if len(frame) < 2:
        return pd.DataFrame({"a": nodes[:0], "b": nodes[:0]})
    same = (frame["key"].to_numpy()[1:] == frame["key"].to_numpy()[:-1]) & (
        frame["path"].to_numpy()[1:] == frame["path"].to_numpy()[:-1]
    )
    starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
    sizes = np.diff(np.concatenate([starts, [len(frame)]]))
    codes = _codes(frame["fingerprint"])
    group = np.repeat(np.arange(len(starts)), sizes)
    a, b = [], []
    # Groups that are one leaf are compared side by side, all at once.
    small = sizes <= _LEAF
    in_small = small[group]
    for shift in range(1, int(sizes[small].max(initial=1))):
        i = np.flatnonzero(in_small[:-shift] & (group[:-shift] == group[shift:]))
        i = i[_bits(codes[i] ^ codes[i + shift]) <= limit]
        a.append(i)
        b.append(i + shift)
    pairs: list = []
    if a:
        a, b = np.concatenate(a), np.concatenate(b)
        apart = _bits(codes[a] ^ codes[b])
        labels = np.arange(len(frame))
        for d in np.unique(apart):
            labels = _join(labels, a[apart == d], b[apart == d], pairs)
    for g in np.flatnonzero(~small):
        block = int(frame["path"].iloc[starts[g]].split("/")[1].split("#")[0])
        i, j = link_group(block_first(codes[starts[g] : starts[g] + sizes[g]], block), limit)
        pairs.append((i + starts[g], j + starts[g]))
    if not pairs:
        return pd.DataFrame({"a": nodes[:0], "b": nodes[:0]})
    a, b = (np.concatenate(side) for side in zip(*pairs))
    return pd.DataFrame({"a": nodes[a], "b": nodes[b]})


def _in_pairs_of_blocks(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """Rows of crowded keys, in blocks of which each pair meets by itself."""
    half = max(1, GROUP_NODES // 2)
    counted = crowded.select("path", "key", F.ceil(F.col("count") / half).cast("int").alias("blocks"))
    cut = rows.join(broadcast_if_small(counted), ["path", "key"])
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    path = F.concat_ws("#", "path", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
    return cut.select(path.alias("path"), "key", "node", "fingerprint")


def linked_nodes(nodes: DataFrame, scheme: Exact, count: int) -> DataFrame:
    """Pairs (a, b) of stored ``nodes`` (node, fingerprint); ``count`` is their number."""
    start = nodes.select(F.lit("").alias("path"), F.lit(0).cast("long").alias("key"), "node", "fingerprint")
    partitions = max(8, -(-count * len(scheme.tables(())) // 100_000))
    todo, found = _route(start, scheme), None
    for level in range(scheme.levels):
        todo = settle(todo, "routed")
        final = level == scheme.levels - 1
        crowded = todo.groupBy("path", "key").count().filter(F.col("count") > GROUP_NODES)
        crowded = settle(crowded, "crowded")
        some = not crowded.isEmpty()
        more = some and not final
        ready = todo
        if some:
            small = broadcast_if_small(crowded.select("path", "key"))
            ready = todo.join(small, ["path", "key"], "left_anti").select("path", "key", "node", "fingerprint")
        if some and final:
            ready = ready.unionByName(_in_pairs_of_blocks(todo, crowded))
        links = _link(ready, scheme.limit, partitions)
        found = links if found is None else found.unionByName(links)
        if not more:
            break
        todo = _route(todo.join(small, ["path", "key"], "left_semi").select("path", "key", "node", "fingerprint"), scheme)
    return settle(found.distinct(), "links")


def node_of(fingerprint_: Column) -> Column:
    """The 64 bits of a fingerprint as a number."""
    return F.conv(F.hex(F.substring(fingerprint_, 2, 7)), 16, 10).cast("long") + F.expr(
        "shiftleft(cast(conv(hex(substring(fingerprint, 1, 1)), 16, 10) as bigint), 56)"
    )


def group_documents(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """doc_id, text_hash, fingerprint and component_id of each row; linked at 3 or fewer differing bits."""
    marked = settle(fingerprints(docs, shingle).withColumn("node", node_of(F.col("fingerprint"))), "fingerprints")
    # Nulls sort after ids, so a null is the smallest only when all are null.
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")).alias("rep")
    reps = settle(marked.groupBy("node").agg(first_row, F.min("fingerprint").alias("fingerprint")), "nodes")
    count = reps.count()
    links = linked_nodes(reps.select("node", "fingerprint"), Exact.for_nodes(count), count)
    roots = components(links)
    rooted = reps.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("first"))
    named = settle(rooted.join(smallest, "root").select("node", "first"), "named")
    return marked.join(named, "node").select(
        "doc_id", "text_hash", "fingerprint", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("first_hash")
    )


def kept_documents(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """One row of each group of linked fingerprints, that of the smallest doc_id."""
    groups = group_documents(docs, shingle=shingle)
    mine = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    winners = groups.filter(mine).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    winners = settle(winners.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "copies"), "winners")
    rows = docs.withColumn("_text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    once = rows.join(winners.filter("copies = 1"), same, "left_semi").select(*(f"`{c}`" for c in docs.columns))
    again = winners.filter("copies > 1")
    if again.isEmpty():
        return once
    # Rows that agree in id and text: one of them stays.
    several = rows.join(again, same, "left_semi").dropDuplicates(["doc_id", "_text_hash"])
    return once.unionByName(several.select(*(f"`{c}`" for c in docs.columns)))


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hex and component_id of each row."""
    groups = group_documents(docs)
    return groups.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")
