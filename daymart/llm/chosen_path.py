"""Near-duplicates by a chosen-path join of shingle sets.

A text's set is cut down to a fixed number of minwise tokens, each of which two
sets share with the chance of their Jaccard similarity. A tree branches all
documents by tokens: the path to a node chooses one token place, sometimes two,
and a document goes to the child named by its token there, so that two sets of
the least similarity still share a child in the mean. A node of few documents
is compared exhaustively; one with more is branched again. Independent trees
are repeated until a pair of the least similarity, which meets in a tree with a
chance that the branching gives, is lost with less than ``1 - RECALL``. A node
that is still large after ``DEPTH`` levels is compared in pairs of blocks, each
in a task of its own, so no chance is lost there and no task takes a node that
grows with the table.

Equal sets are one node. Before the search, each crowded child of the root
picks the member that most resembles the others, and all members are compared
with that one alone: a family of copies becomes one component in as many
comparisons as it has members. The search then leaves out what lies in one
component. Members of a node that share enough tokens meet once more with their
whole sets, all with all in one product of the node's shingles, so families of
texts just below the limit cost no row for each pair, and what is linked is
counted, not estimated.

Defined results: null texts, and texts without words, have empty sets, which
are linked with nothing; fewer words than a shingle are one shingle; texts of
any length are taken whole; rows of one text are in one component; a null
doc_id is kept, and never the smallest id of a component unless all its ids are
null; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.llm.components import components
from daymart.llm.simhash import _join, shingle_hashes
from daymart.llm.tokens import small_batches
from daymart.operators.lookup import broadcast_if_small, lookup_key
from daymart.operators.scratch import settle

SHINGLE = 3
#: The least similarity of a link, in hundredths.
LEAST = 85
#: Chance to find a pair of the least similarity that parts at no level up to DEPTH.
RECALL = 0.9999
DEPTH = 4
TOKENS = 128
#: Documents of a node that are compared with each other.
NODE_ROWS = 512
#: Members of a child of the root among which one is picked.
_SLICE, _LOOKED_AT = 2048, 64
#: Pairs that take part in confirming under one id, before the id is dealt out.
_PAIRS_OF_ONE = 2000
_SEED = 11
_SHINGLES_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 16
#: Groups up to this size are intersected pair by pair, others in blocks of so many shingles.
_FEW, _COLUMNS = 8, 4096
_ODD, _FINAL = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

MARKS = "doc_id long, text_hash long, n_shingles long, digest binary, tokens binary, keys array<long>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_ODD)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_FINAL)
    return x ^ (x >> np.uint64(31))


def second_place(least: int = LEAST) -> float:
    """Chance of a second token place at a node, so that 1 / similarity are chosen in the mean."""
    return 100 / least - 1


def meeting_chance(depth: int, least: int = LEAST) -> float:
    """Chance that a pair of the least similarity shares a node ``depth`` levels down a tree."""
    alike, second, chance = least / 100, second_place(least), 1.0
    for _ in range(depth):
        one = alike * chance
        chance = (1 - second) * one + second * (1 - (1 - one) ** 2)
    return chance


def trees_for(recall: float = RECALL, depth: int = DEPTH, least: int = LEAST) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting_chance(depth, least)))


def least_agreeing(least: int = LEAST, loss: float = 1e-5) -> int:
    """Shared tokens that a pair of the least similarity has but for a chance of ``loss``."""
    p, below = least / 100, 0.0
    for n in range(TOKENS + 1):
        below += math.comb(TOKENS, n) * p**n * (1 - p) ** (TOKENS - n)
        if below > loss:
            return n
    return TOKENS


def _root_places(trees: int, least: int = LEAST) -> list[tuple[int, int]]:
    """(tree, token place) of each branch at the root of each tree."""
    draw = np.random.default_rng(_SEED)
    out = []
    for tree in range(trees):
        chosen = draw.choice(TOKENS, 2 if draw.random() < second_place(least) else 1, replace=False)
        out += [(tree, int(place)) for place in chosen]
    return out


def _constants() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([_SEED, 1])
    flips = draw.integers(0, 1 << 64, TOKENS, dtype=np.uint64)
    return flips, draw.integers(0, 1 << 64, TOKENS, dtype=np.uint64) | np.uint64(1)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, TOKENS) minwise tokens of sets that are not empty."""
    flips, factors = _constants()
    out = np.empty((len(sets), TOKENS), dtype=np.uint64)
    a = 0
    while a < len(sets):
        b, held = a, 0
        while b < len(sets) and (b == a or held + len(sets[b]) <= _SHINGLES_AT_ONCE):
            held += len(sets[b])
            b += 1
        flat = np.concatenate(sets[a:b])
        starts = np.cumsum([0, *map(len, sets[a : b - 1])])
        for k in range(TOKENS):
            out[a:b, k] = np.minimum.reduceat((flat ^ flips[k]) * factors[k], starts)
        a = b
    return _mixed(out)


def set_marks(docs: DataFrame, shingle: int, trees: int, least: int) -> DataFrame:
    """Each row's set: size, digest, tokens of 16 bits, and keys of its children of the roots."""
    places = _root_places(trees, least)

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seed = np.array([tree << 32 | place for tree, place in places], dtype=np.uint64)
        for frame in small_batches(frames, "text"):
            sets = [np.unique(shingle_hashes(t, shingle)) for t in frame["text"]]
            some = [k for k, s in enumerate(sets) if len(s)]
            out = frame[["doc_id", "text_hash"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["n_shingles"] = [len(s) for s in sets]
            digest, tokens, keys = ([None] * len(sets) for _ in range(3))
            if some:
                minima = minwise([sets[k] for k in some])
                roots = _mixed(minima[:, [place for _, place in places]] + seed * np.uint64(_ODD)).view(np.int64)
                short = (minima & np.uint64(0xFFFF)).astype("<u2")
                for row, k in enumerate(some):
                    digest[k] = xxhash.xxh3_128_digest(sets[k].tobytes())
                    tokens[k], keys[k] = short[row].tobytes(), roots[row]
            yield out.assign(digest=digest, tokens=tokens, keys=keys)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInPandas(mark, MARKS)


def _tokens(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u2").reshape(len(column), TOKENS)


def _agreeing(tokens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of shared tokens of rows ``a`` and ``b``."""
    out = np.empty(len(a), dtype=np.int64)
    for k in range(0, len(a), _PAIRS_AT_ONCE):
        part = slice(k, k + _PAIRS_AT_ONCE)
        out[part] = (tokens[a[part]] == tokens[b[part]]).sum(axis=1)
    return out


def _groups(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Frames of whole groups of sorted rows, with where each group starts and its size."""
    held = None

    def starts_of(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        new = np.zeros(len(frame), dtype=bool)
        new[0] = True
        for column in by:
            values = frame[column].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        return starts, np.diff(starts, append=len(frame))

    for frame in frames:
        if not len(frame):
            continue
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        starts, sizes = starts_of(frame)
        # The last group of a frame may go on in the next one.
        held = frame.iloc[starts[-1] :].reset_index(drop=True)
        if len(starts) > 1:
            yield frame.iloc[: starts[-1]], starts[:-1], sizes[:-1]
    if held is not None:
        yield held, *starts_of(held)


def _pick(tokens: np.ndarray) -> tuple[int, int]:
    """The row that shares most tokens with up to some of the others, and how many."""
    step = max(1, len(tokens) // _LOOKED_AT)
    shared = np.zeros(len(tokens), dtype=np.int64)
    looked_at = tokens[::step][:_LOOKED_AT]
    for other in looked_at:
        shared += (tokens == other).sum(axis=1)
    best = int(np.argmax(shared))
    return best, int(shared[best]) * 1000 // (len(looked_at) * TOKENS)


def _partitions(rows: int) -> int:
    return max(8, -(-rows // 50_000))


def _crowded(dealt: DataFrame) -> DataFrame:
    """key and members of each node that holds more than one component."""
    counted = dealt.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    return counted.filter("low < high").select("key", "members")


def _with_tokens(dealt: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (key, node, root, ...) of nodes that hold several components, with their tokens and sizes."""
    several = settle(_crowded(dealt), "several")
    kept = dealt.join(broadcast_if_small(several), "key")
    return kept.join(nodes.select("node", "tokens", "size"), "node")


def leader_pairs(rooted: DataFrame, nodes: DataFrame, first: int, count: int, enough: int) -> DataFrame:
    """Pairs (a, b) of each member of some children of the roots with the member picked there."""
    dealt = rooted.select(F.explode(F.slice("keys", first + 1, count)).alias("key"), "node", "root")
    cut = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / _SLICE)).cast("int")
    rows = settle(_with_tokens(dealt, nodes).withColumn("slice", cut), "members")

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts, sizes in _groups(frames, ["key", "slice"]):
            tokens, node, root = _tokens(frame["tokens"]), frame["node"].to_numpy(), frame["root"].to_numpy()
            chosen, score = starts.copy(), np.zeros(len(starts), dtype=np.int64)
            for g in np.flatnonzero(sizes > 2):
                place, score[g] = _pick(tokens[starts[g] : starts[g] + sizes[g]])
                chosen[g] += place
            yield pd.DataFrame(
                {
                    "key": frame["key"].to_numpy()[starts],
                    "score": score,
                    "leader": node[chosen],
                    "leader_root": root[chosen],
                    "leader_tokens": frame["tokens"].to_numpy()[chosen],
                }
            )

    partitions = _partitions(rows.count())
    sorted_ = rows.repartition(partitions, "key", "slice").sortWithinPartitions("key", "slice", "node")
    picked = sorted_.mapInPandas(pick, "key long, score long, leader long, leader_root long, leader_tokens binary")
    best = F.max(F.struct("score", "leader", "leader_root", "leader_tokens")).alias("best")
    leaders = picked.groupBy("key").agg(best).select("key", "best.leader", "best.leader_root", "best.leader_tokens")
    # A leader goes to each slice of its key, so a crowded key is met by many tasks.
    slices = rows.select("key", "slice").distinct()
    led = rows.join(settle(slices.join(leaders, "key"), "leaders"), ["key", "slice"])
    led = led.filter("root <> leader_root").select("node", "tokens", "leader", "leader_tokens")

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                shared = (_tokens(frame["tokens"]) == _tokens(frame["leader_tokens"])).sum(axis=1)
                near = frame[shared >= enough]
                yield pd.DataFrame({"a": near["leader"], "b": near["node"]})

    return _once(led.mapInPandas(meet, "a long, b long"))


def _once(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _branch(rows: DataFrame, least: int) -> DataFrame:
    """Rows (key, node, root, tokens, size) in the children of their nodes."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            key, tokens = frame["key"].to_numpy().view(np.uint64), _tokens(frame["tokens"])
            drawn = _mixed(key ^ np.uint64(_FINAL))
            first = (drawn % np.uint64(TOKENS)).astype(np.int64)
            # A second place is another one.
            second = (first + 1 + (drawn >> np.uint64(8)) % np.uint64(TOKENS - 1)).astype(np.int64) % TOKENS
            both = (drawn >> np.uint64(40)) < np.uint64(int(second_place(least) * (1 << 24)))
            for place, chosen in ((first, np.ones(len(frame), dtype=bool)), (second, both)):
                part = np.flatnonzero(chosen)
                token = tokens[part, place[part]].astype(np.uint64) << np.uint64(8) | place[part].astype(np.uint64)
                child = _mixed(key[part] * np.uint64(_ODD) + token)
                yield frame.iloc[part].assign(key=child.view(np.int64))

    return rows.mapInPandas(deal, rows.schema)


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of large nodes in blocks, of which each pair meets by itself (part, other half)."""
    half = NODE_ROWS // 2
    blocks = F.ceil(F.col("members") / half).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.concat_ws("-", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
    return cut.withColumn("part", part)


MET = "key long, part string, own int, other int, node long, root long"


def _exhaustive(rows: DataFrame, enough: int, least: int, partitions: int) -> DataFrame:
    """Rows (key, part, own, other, node, root, tokens, size) that share enough tokens with one of another component."""

    def near_of(frame: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        tokens, size = _tokens(frame["tokens"]), frame["size"].to_numpy()
        near = np.zeros(len(frame), dtype=bool)
        for i, j in _partners(frame, starts, sizes):
            low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            keep = 100 * low >= least * high
            i, j = i[keep], j[keep]
            keep = _agreeing(tokens, i, j) >= enough
            near[i[keep]] = near[j[keep]] = True
        return near

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts, sizes in _groups(frames, ["key", "part"]):
            yield frame.loc[near_of(frame, starts, sizes), [c.split()[0] for c in MET.split(", ")]]

    sorted_ = rows.repartition(partitions, "key", "part").sortWithinPartitions("key", "part")
    return sorted_.mapInPandas(compare, MET)


def _partners(frame: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group and different components, some at a time."""
    root, own = frame["root"].to_numpy(), frame["own"].to_numpy()
    two_blocks = own != frame["other"].to_numpy()
    until = np.repeat(starts + sizes, sizes)
    partners = until - np.arange(len(frame)) - 1
    upto = np.cumsum(partners)
    a = 0
    while a < len(frame):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + _PAIRS_AT_ONCE, "right")))
        n = partners[a:b]
        i = np.repeat(np.arange(a, b), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        a = b
        # Two blocks that meet leave the pairs inside either to the block's own meeting.
        keep = (root[i] != root[j]) & (~two_blocks[i] | (own[i] != own[j]))
        yield i[keep], j[keep]


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of a group's sets share, all pairs at once.

    Elements that several sets hold are columns of a matrix of which a block
    at a time is made and multiplied.
    """
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = held > 1
    number = np.cumsum(several) - 1
    row, column = row[several[column]], number[column[several[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(several.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        block = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        block[row[a:b], column[a:b] - start] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _exact_links(frame: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that join what similar sets of different components join: a forest."""
    size = frame["set"].str.len().to_numpy()
    root = frame["root"].to_numpy()
    a, b = [], []
    for start, n in zip(starts.tolist(), sizes.tolist()):
        sets = frame["set"].iloc[start : start + n].tolist()
        group = frame.iloc[start : start + n]
        shared = shared_shingles(sets) if n > _FEW else None
        for i, j in _partners(group, np.array([0]), np.array([n])):
            if shared is None:
                both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], dtype=np.int64)
            else:
                both = shared[i, j]
            keep = 100 * both >= least * (size[start + i] + size[start + j] - both)
            a.append(start + i[keep])
            b.append(start + j[keep])
    pairs: list = []
    if a:
        _, labels = np.unique(root, return_inverse=True)
        # Rows of one component are joined already.
        first = np.full(labels.max() + 1, len(root))
        np.minimum.at(first, labels, np.arange(len(root)))
        _join(first[labels], np.concatenate(a), np.concatenate(b), pairs)
    if not pairs:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    left, right = (np.concatenate(side) for side in zip(*pairs))
    return left, right


def exact_links(met: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) among rows that meet, by their whole sets; stored."""
    rows = met.join(sets, "node")

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts, sizes in _groups(frames, ["key", "part"]):
            a, b = _exact_links(frame, starts, sizes, least)
            node = frame["node"].to_numpy()
            yield pd.DataFrame({"a": node[a], "b": node[b]})

    sorted_ = rows.repartition(_partitions(10 * met.count()), "key", "part").sortWithinPartitions("key", "part")
    return settle(_once(sorted_.mapInPandas(link, "a long, b long")), "links")


def search(rooted: DataFrame, nodes: DataFrame, enough: int, least: int) -> DataFrame:
    """Rows that the trees bring together, of nodes and their components, with where they meet; stored."""
    columns = ["key", "node", "root", "tokens", "size"]
    dealt = rooted.select(F.explode("keys").alias("key"), "node", "root")
    rows = settle(_with_tokens(dealt, nodes).select(*columns, "members"), "children")
    found = None
    for level in range(1, DEPTH + 1):
        is_small = F.col("members") <= NODE_ROWS
        ready = rows.filter(is_small).select(*columns, F.lit(f"{level}").alias("part"), F.lit(0).alias("own"), F.lit(0).alias("other"))
        large = rows.filter(~is_small)
        if level == DEPTH:
            ready = ready.unionByName(_in_blocks(large).select(*ready.columns))
        pairs = _exhaustive(ready, enough, least, _partitions(rows.count()))
        found = pairs if found is None else found.unionByName(pairs)
        if level == DEPTH or large.isEmpty():
            break
        deeper = settle(_branch(large.select(*columns), least), "branched")
        several = settle(_crowded(deeper), "several")
        rows = settle(deeper.join(broadcast_if_small(several), "key"), "children")
    return settle(found, "met")


def _dealt_out(pairs: DataFrame, side: str, sets: DataFrame) -> DataFrame:
    """``pairs`` with the set of one side; an id of very many pairs is met in several tasks."""
    other = "b" if side == "a" else "a"
    busy = pairs.groupBy(side).count().filter(F.col("count") > _PAIRS_OF_ONE)
    shares = F.ceil(F.col("count") / _PAIRS_OF_ONE).cast("int").alias("shares")
    busy = settle(busy.select(F.col(side).alias("busy"), shares), "busy")
    share: Column = F.when(F.col("shares").isNotNull(), F.pmod(F.xxhash64(other), F.col("shares"))).otherwise(0)
    dealt = pairs.join(broadcast_if_small(busy), pairs[side] == busy["busy"], "left").withColumn("share", share.cast("int"))
    dealt = dealt.drop("busy", "shares")
    copies = sets.join(broadcast_if_small(busy), sets["node"] == busy["busy"], "left")
    copies = copies.select(
        F.col("node").alias(side),
        F.col("set").alias(f"set_{side}"),
        F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share"),
    )
    return dealt.join(copies, [side, "share"]).drop("share")


def whole_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """node and set of the ``wanted`` nodes, from the texts of their first rows; stored."""
    chosen = nodes.join(wanted, "node", "left_semi").select("node", "rep.doc_id", "rep.text_hash")
    chosen = settle(chosen.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}), "wanted")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    texts = rows.join(broadcast_if_small(chosen), same).select("node", "text")

    def sets_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, "text"):
            once = frame.drop_duplicates("node")
            sets = [np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in once["text"]]
            yield pd.DataFrame({"node": once["node"].to_numpy(), "set": sets})

    sets = settle(texts.mapInPandas(sets_of, "node long, set array<long>"), "sets")
    if not sets.groupBy("node").count().filter("count > 1").isEmpty():
        # Rows that agree in id and text: one set is enough.
        sets = settle(sets.groupBy("node").agg(F.first("set").alias("set")), "sets")
    return sets


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, least: int) -> DataFrame:
    """The pairs whose whole sets are similar enough; stored."""
    pairs = settle(pairs, "candidates")
    sets = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, docs, shingle)
    both = _dealt_out(_dealt_out(pairs, "a", sets), "b", sets)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    joint = F.size("set_a") + F.size("set_b") - shared
    return settle(both.filter(100 * shared >= least * joint).select("a", "b"), "links")


def near_components(
    docs: DataFrame, *, shingle: int = SHINGLE, least: int = LEAST, recall: float = RECALL
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``."""
    trees = trees_for(recall, DEPTH, least)
    enough = least_agreeing(least)
    marks = settle(set_marks(docs, shingle, trees, least), "sets")
    # Nulls sort after ids, so a null is the smallest only when all are null.
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")).alias("rep")
    same = [F.first(c).alias(c) for c in ("tokens", "keys")]
    counted = marks.filter(F.col("digest").isNotNull()).groupBy("digest")
    grouped = counted.agg(rep, *same, F.first("n_shingles").alias("size"), F.count(F.lit(1)).alias("copies"))
    nodes = settle(grouped.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")

    rooted = nodes.select("node", "keys", F.col("node").alias("root"))
    branches = len(_root_places(trees, least))
    links = None
    for first in (0, branches // 2):
        pairs = leader_pairs(rooted, nodes, first, branches // 2, enough)
        links = _joined(links, confirmed(pairs, nodes, docs, shingle, least))
        rooted = _rooted(nodes, links)
    met = search(rooted, nodes, enough, least)
    sets = whole_sets(met.select("node").distinct(), nodes, docs, shingle)
    links = _joined(links, exact_links(met, sets, least))
    roots = components(links)
    named = nodes.join(roots, "node", "left").select("digest", "copies", "rep", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("first"))
    named = named.join(smallest, "root").select("digest", "copies", F.col("first.doc_id").alias("component_id"))
    found = lookup_key(marks, settle(named, "named"), ["digest"], ["component_id"], count_column="copies")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _joined(links: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if links is None else links.unionByName(more)


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    joined = nodes.join(components(links), "node", "left")
    return settle(joined.select("node", "keys", F.coalesce("root", "node").alias("root")), "rooted")
