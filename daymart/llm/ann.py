"""Nearest neighbours from balanced posting lists.

Largest inner product becomes nearest distance by one more dimension, which
gives all vectors the same length. Centroids come from a balanced k-means on a
bounded sample: a full cluster charges a fee, and the fees stay with the
centroids as one more component, so that lists of all rows are about as even as
those of the sample (vectors whose lengths lie far apart stay uneven: short
ones share a list). Every vector goes to the posting list of its nearest
centroid and, near a boundary, to those of further centroids that are almost as
near and do not lie behind one that it is in already. Centroids are searched by
a best-first walk on a graph of neighbouring centroids held in memory.

A query reads the lists whose centroid's distance is within a ratio of the
nearest one, however many these are. The ratio is calibrated: it is the least
one by which sample vectors find ``recall`` of their neighbours in the sample.
Rows of the table lie closer to a query than those of a sample, so lists hold
at least as many of the true neighbours. Vectors without any structure have all
centroids at about one distance: there a query reads most lists, which is the
work of all pairs. Queries that find fewer than ``k`` rows go through all rows
in blocks.

Equal vectors are one vector with the ids of its ``k`` + 1 smallest copies;
further copies can be in no result, as ties go to smaller ids. Equal queries
are searched once. So no list and no query is crowded by copies.

Defined results: vectors that are null, zero or of another length than most,
or hold null or non-finite components, take no part, as query or as candidate,
and neither do null ids; rows that repeat an id and vector are one; fewer candidates than
``k`` are all returned; an empty table gives no rows. Only vec_id and
embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.operators.scratch import settle

NEAREST = 20
EVERY = 20
#: Rows that centroids are fitted on, and the most centroids there are.
SAMPLE_ROWS = 20_000
MAX_LISTS = 4_096
LIST_ROWS = 200
#: A vector joins lists whose centroid is within this ratio of its nearest.
BOUNDARY_RATIO, MAX_COPIES = 1.15, 4
#: Neighbours that the calibrated ratio finds, and the sample vectors asked.
RECALL, ASKED = 0.97, 512
#: Lists of a cell; neighbouring lists share one, so a query is sent once for them.
CELL_LISTS = 16
_DEGREE, _BACK, _BEAM = 16, 6, 32
_SEED = 11
_ROUNDS, _FEE_ROUNDS = 8, 24
_AT_ONCE, _QUERIES_AT_ONCE = 1024, 256


@dataclass
class Centroids:
    """Centroids and the graph over them."""

    points: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    longest: float
    ratio: float = 1.0

    def lift(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Two more components: one makes inner products distances, one meets the fees.

        A query's length does not change what is nearest to it, so all have one.
        """
        none = np.zeros((len(vectors), 1))
        squares = (vectors**2).sum(axis=1)[:, None]
        if query:
            return np.hstack([vectors * (self.longest / np.sqrt(squares)), none, none])
        return np.hstack([vectors, np.sqrt(np.maximum(self.longest**2 - squares, 0.0)), none])

    def distances(self, points: np.ndarray) -> np.ndarray:
        squares = (points**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1)
        return np.sqrt(np.maximum(squares - 2 * points @ self.points.T, 0.0))

    def within(self, points: np.ndarray) -> np.ndarray:
        """Which lists each query reads: (queries, lists).

        The walk is widened until its last centroid lies beyond the ratio; when
        it would open most of the graph, distances to all are less work.
        """
        total = len(self.points)
        out = np.zeros((len(points), total), dtype=bool)
        if math.isinf(self.ratio):
            return ~out
        left, wanted = np.arange(len(points)), 32
        while len(left) and wanted < total / 4:
            ids, dist = self.search(points[left], wanted)
            close = (dist <= self.ratio * dist[:, :1]) & (ids >= 0)
            row, j = np.nonzero(close)
            out[left[row], ids[row, j]] = True
            left, wanted = left[close[:, -1]], 2 * wanted
        dist = self.distances(points[left])
        out[left] = dist <= self.ratio * dist.min(axis=1, keepdims=True)
        return out

    def search(self, points: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of each point, nearest first, and distances.

        All points walk the graph together: each opens the nearest centroid
        that it has not opened yet, until its best ones are all open.
        """
        n, beam = len(points), max(_BEAM, 2 * wanted)
        total = len(self.points)
        squares = (self.points**2).sum(axis=1)
        own = (points**2).sum(axis=1)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, total + 1), dtype=bool)
        seen[:, total] = True
        ids = np.tile(self.entries, (n, 1))
        seen[rows, ids] = True
        dist = own[:, None] + squares[ids] - 2 * points @ self.points[self.entries].T
        opened = np.zeros(ids.shape, dtype=bool)
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, opened = ids[rows, order], dist[rows, order], opened[rows, order]
            waiting = np.where(opened, np.inf, dist)[:, : max(wanted + 8, 24)]
            nearest = waiting.argsort(axis=1)[:, :3]
            live = np.isfinite(waiting[rows, nearest])
            if not live.any():
                break
            opened[rows, nearest] |= live
            around = np.where(live[:, :, None], self.graph[ids[rows, nearest]], total).reshape(n, -1)
            around = np.sort(around, axis=1)
            around[:, 1:][around[:, 1:] == around[:, :-1]] = total
            new = ~seen[rows, around]
            seen[rows, around] = True
            at = np.where(new, around, 0)
            r, j = np.nonzero(new)
            near = np.full(new.shape, np.inf)
            near[r, j] = own[r] + squares[at[r, j]] - 2 * np.einsum("nd,nd->n", points[r], self.points[at[r, j]])
            ids = np.hstack([ids, at])
            dist = np.hstack([dist, near])
            opened = np.hstack([opened, ~new])
        dist = np.sqrt(np.maximum(dist[:, :wanted], 0.0))
        return np.where(np.isfinite(dist), ids[:, :wanted], -1), dist


def _balanced(points: np.ndarray, k: int) -> np.ndarray:
    """k-means whose distances carry a fee that grows with a cluster's size.

    Returns the centres with the root of their fees as a last component: the
    distance to a point that has 0 there is the distance with the fee.
    """
    draw = np.random.default_rng(_SEED)
    centres = points[np.sort(draw.choice(len(points), k, replace=False))].copy()
    fee = np.zeros(k)
    step = 0.2
    for turn in range(_ROUNDS + _FEE_ROUNDS):
        own = np.empty(len(points), dtype=int)
        spread = 0.0
        for a in range(0, len(points), _AT_ONCE):
            part = points[a : a + _AT_ONCE]
            dist = (part**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * part @ centres.T
            own[a : a + _AT_ONCE] = (dist + fee).argmin(axis=1)
            spread += float(np.maximum(dist.min(axis=1), 0).sum())
        sizes = np.bincount(own, minlength=k)
        if turn < _ROUNDS:
            sums = np.zeros_like(centres)
            np.add.at(sums, own, points)
            filled = sizes > 0
            centres[filled] = sums[filled] / sizes[filled, None]
        else:
            step *= 0.9
        fee += step * spread / len(points) * np.clip(sizes * k / len(points) - 1, -1, 1)
    return np.hstack([centres[:, :-1], centres[:, -1:], np.sqrt(fee - fee.min())[:, None]])


def fit_centroids(sample: np.ndarray, rows: int, longest: float, k: int = NEAREST, recall: float = RECALL) -> Centroids:
    """Centroids for ``rows`` vectors, from a sample of them."""
    shell = Centroids(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), longest)
    points = shell.lift(sample)
    lists = max(1, min(MAX_LISTS, len(points), math.ceil(rows / LIST_ROWS)))
    centres = _balanced(points[:, :-1], lists)
    # Neighbouring lists get neighbouring numbers.
    centres = centres[_in_line(centres, np.arange(lists))]
    dist = (centres**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * centres @ centres.T
    np.fill_diagonal(dist, np.inf)
    graph = dist.argsort(axis=1, kind="stable")[:, : min(_DEGREE, max(1, lists - 1))]
    # A centroid that is near to none is still reached from those nearest to it,
    # and some links to far ones keep the graph in one piece.
    links = np.full((lists, _BACK), lists)
    used = np.zeros(lists, dtype=int)
    for own, around in enumerate(graph):
        for other in around[used[around] < _BACK][:2]:
            links[other, used[other]] = own
            used[other] += 1
    draw = np.random.default_rng(_SEED)
    graph = np.hstack([graph, links, draw.integers(0, lists, (lists, 2))])
    entries = np.unique(draw.integers(0, lists, min(lists, 16)))
    centroids = Centroids(centres, graph, entries, longest)
    centroids.ratio = _calibrated(centroids, sample, k, recall)
    return centroids


def _in_line(centres: np.ndarray, own: np.ndarray) -> np.ndarray:
    """An order of centres in which halves, and halves of these, lie apart."""
    if len(own) <= CELL_LISTS:
        return own
    part = centres[own] - centres[own].mean(axis=0)
    far = part[(part**2).sum(axis=1).argmax()]
    order = own[np.argsort(part @ far, kind="stable")]
    half = CELL_LISTS * max(1, round(len(own) / CELL_LISTS / 2))
    return np.concatenate([_in_line(centres, order[:half]), _in_line(centres, order[half:])])


def _calibrated(centroids: Centroids, sample: np.ndarray, k: int, recall: float) -> float:
    """The ratio by which sample vectors find ``recall`` of their neighbours in the sample."""
    if recall >= 1:
        return math.inf
    where: dict[int, list[int]] = {}
    for rows, lists in _assigned(centroids, centroids.lift(sample)):
        for row, own in zip(rows.tolist(), lists.tolist()):
            where.setdefault(row, []).append(own)
    needed = []
    for q in range(min(ASKED, len(sample))):
        scores = sample @ sample[q]
        scores[q] = -np.inf
        near = np.argpartition(-scores, min(k, len(scores) - 1))[:k]
        dist = centroids.distances(centroids.lift(sample[q : q + 1], query=True))[0]
        needed += [dist[where[n]].min() / max(dist.min(), 1e-300) for n in near.tolist() if n != q]
    return max(1.0, float(np.quantile(needed, recall, method="higher"))) if needed else 1.0


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)


def _assigned(centroids: Centroids, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, list) pairs: the nearest list, and others at the boundary."""
    for a in range(0, len(points), _AT_ONCE):
        part = points[a : a + _AT_ONCE]
        ids, dist = centroids.search(part, MAX_COPIES * 2)
        rows = np.arange(a, a + len(part))
        taken = [ids[:, 0]]
        copies = np.ones(len(part), dtype=int)
        yield rows, ids[:, 0]
        for j in range(1, ids.shape[1]):
            here = ids[:, j]
            wanted = (here >= 0) & (dist[:, j] <= BOUNDARY_RATIO * dist[:, 0]) & (copies < MAX_COPIES)
            # Not when a list that it is in is nearer to this centroid than it is.
            for other in taken:
                between = np.linalg.norm(centroids.points[here] - centroids.points[other], axis=1)
                wanted &= (other < 0) | (between > dist[:, j])
            taken.append(np.where(wanted, here, -1))
            copies += wanted
            yield rows[wanted], here[wanted]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, with components as doubles."""
    wide = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    good = wide.filter("vec_id is not null and v is not null and size(v) > 0")
    good = good.filter(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    # -0.0 and 0.0 are one number, but not one key.
    return good.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: key, v and the ``keep`` smallest ids.

    The rank is cut within each task before rows meet, so a vector that a third
    of all rows share costs ``keep`` rows a task.
    """
    keyed = rows.distinct().withColumn("key", F.xxhash64("v"))
    rank = F.row_number().over(W.partitionBy("key", "v").orderBy("vec_id"))
    few = keyed.withColumn("_rank", rank).filter(F.col("_rank") <= keep)
    return few.groupBy("key", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _best(scored: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = scored.sort_values(["q", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return ordered[ordered.groupby("q").cumcount() < k]


PAIRS = "q long, vec_id long, score double"


def _scored(
    queries: pd.DataFrame, rows: pd.DataFrame, k: int, read: np.ndarray | None = None, lists: np.ndarray | None = None
) -> Iterator[pd.DataFrame]:
    """The ``k`` best of ``rows`` for each of ``queries``, in blocks.

    A matrix product finds the rows that can be among the best; their scores
    are then summed as ``inner`` sums them. With ``read`` (queries, lists) and
    each row's number in ``lists``, queries see the rows of their lists.
    """
    if not len(queries) or not len(rows):
        return
    ids = rows["ids"].to_numpy()
    points, asked = _matrix(rows["v"]), _matrix(queries["v"])
    names = queries["q"].to_numpy()
    longest = np.sqrt((points**2).sum(axis=1).max())
    for a in range(0, len(queries), _QUERIES_AT_ONCE):
        part = asked[a : a + _QUERIES_AT_ONCE]
        at = np.arange(len(points))
        if read is not None:
            sees = read[a : a + _QUERIES_AT_ONCE]
            at = np.flatnonzero(sees.any(axis=0)[lists])
        if not len(at):
            continue
        near = part @ points[at].T
        if read is not None:
            near[~sees[:, lists[at]]] = -np.inf
        # Sums are rounded; rows as good as the last one count, as smaller ids go first.
        slack = 1e-11 * points.shape[1] * np.sqrt((part**2).sum(axis=1)) * longest
        last = -np.partition(-near, k - 1, axis=1)[:, k - 1] if len(at) > k else np.full(len(part), -np.inf)
        q, row = np.nonzero((near >= (last - slack)[:, None]) & (near > -np.inf))
        copies = ids[at[row]]
        found = pd.DataFrame({"q": names[a + q], "score": _pairwise(part, points, q, at[row])})
        counts = np.fromiter(map(len, copies), dtype=np.int64, count=len(copies))
        found = found.loc[np.repeat(np.arange(len(found)), counts)].reset_index(drop=True)
        found["vec_id"] = np.concatenate([*copies, []]).astype(np.int64)
        yield _best(found, k)[["q", "vec_id", "score"]]


def _pairwise(queries: np.ndarray, points: np.ndarray, q: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The inner product of each pair, summed as ``inner`` sums it."""
    out = np.zeros(len(q))
    for a in range(0, len(q), 1 << 16):
        left, right = queries[q[a : a + (1 << 16)]], points[row[a : a + (1 << 16)]]
        for d in range(points.shape[1]):
            out[a : a + (1 << 16)] += left[:, d] * right[:, d]
    return out


def inner(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, summed component by component so that every run agrees."""
    out = np.zeros((len(queries), len(points)))
    for d in range(points.shape[1]):
        out += queries[:, d : d + 1] * points[:, d]
    return out


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query; a vector found in several lists counts once."""
    once = rows.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, *, k: int = NEAREST, every: int = EVERY, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the neighbours of every n-th vector.

    With a ``recall`` of 1 every list is read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == sizes["n"])
    stored = settle(_distinct(rows, k + 1), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    about = stored.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("longest")).first()
    sample = stored.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).select("v").collect()
    centroids = fit_centroids(np.array([r["v"] for r in sample], dtype=np.float64), about["n"], about["longest"], k, recall)
    # At most MAX_LISTS centroids: some MB.
    spread = spark.sparkContext.broadcast(centroids)

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, where in _assigned(spread.value, spread.value.lift(_matrix(frame["v"]))):
                held = frame.iloc[row].assign(cell=where // CELL_LISTS, list=where % CELL_LISTS)
                yield held[["cell", "list", "v", "ids"]]

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = 1 << np.arange(CELL_LISTS)
        for frame in frames:
            for a in range(0, len(frame), _AT_ONCE):
                part = frame.iloc[a : a + _AT_ONCE]
                read = spread.value.within(spread.value.lift(_matrix(part["v"]), query=True))
                wide = np.pad(read, ((0, 0), (0, -read.shape[1] % CELL_LISTS)))
                masks = wide.reshape(len(part), -1, CELL_LISTS) @ bits
                row, cell = np.nonzero(masks)
                yield part.iloc[row].assign(cell=cell, lists=masks[row, cell])[["cell", "lists", "q", "v"]]

    postings = stored.mapInPandas(post, "cell int, list int, v array<double>, ids array<long>")
    members = settle(rows.filter(F.col("vec_id") % every == 0).select("vec_id", F.xxhash64("v").alias("key"), "v").distinct(), "members")
    # A query is the vector of at least one member; its smallest one names it.
    queries = settle(members.groupBy("key", "v").agg(F.min("vec_id").alias("q")), "queries")
    asked = queries.select("q", "v").mapInPandas(ask, "cell int, lists int, q long, v array<double>")

    def scan(_, own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["lists", "q"])
        read = (own["lists"].to_numpy()[:, None] >> np.arange(CELL_LISTS) & 1).astype(bool)
        parts = list(_scored(own, held, k + 1, read, held["list"].to_numpy()))
        return pd.concat(parts) if parts else pd.DataFrame({"q": [], "vec_id": [], "score": []})

    # Beyond MAX_LISTS lists grow with the table; blocks of a cell and of its
    # queries then meet in tasks of their own.
    width = len(centroids.points) * LIST_ROWS
    blocks = math.ceil(about["n"] / (2 * width))
    query_blocks = math.ceil(about["n"] / every / (2 * width))
    group = ["cell", "block", "query_block"]
    postings = _in_blocks(postings, "block", F.xxhash64("v"), blocks, "query_block", query_blocks)
    asked = _in_blocks(asked, "query_block", F.xxhash64("q"), query_blocks, "block", blocks)
    found = asked.groupBy(*group).cogroup(postings.groupBy(*group)).applyInPandas(scan, PAIRS)
    best = settle(_top(found, k + 1), "found")
    # A query whose lists hold fewer rows than it wants reads all rows.
    total = stored.agg(F.sum(F.size("ids"))).first()[0]
    last = best.groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    few = F.coalesce("n", F.lit(0)) < min(k + 1, total)
    broad = settle(queries.join(last, "q", "left").filter(few).select("q", "v"), "broad")
    if not broad.isEmpty():
        best = best.join(broad.select("q"), "q", "left_anti").unionByName(_exhaustive(broad, stored, k + 1))
    named = queries.select("key", "v", "q").join(best.select("q", "vec_id", "score"), "q")
    listed = named.groupBy("key", "v").agg(F.collect_list(F.struct("score", "vec_id")).alias("found"))
    # Both hold a query's neighbours as one row, so members do not multiply rows.
    mine = members.select(F.col("vec_id").alias("query_id"), "key", "v").join(listed, ["key", "v"])
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))

    def better(a, b):
        by_id = F.when(a["vec_id"] < b["vec_id"], -1).when(a["vec_id"] > b["vec_id"], 1).otherwise(0)
        return F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(by_id)

    ordered = F.slice(F.array_sort(others, better), 1, k)
    out = mine.select("query_id", F.posexplode(ordered).alias("place", "x"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def _in_blocks(rows: DataFrame, own: str, key, blocks: int, other: str, others: int) -> DataFrame:
    """Rows with the number of their block, once for each block of the other side."""
    numbered = rows.withColumn(own, F.pmod(key, F.lit(blocks)).cast("int"))
    return numbered.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _exhaustive(queries: DataFrame, stored: DataFrame, k: int) -> DataFrame:
    """All rows for each of ``queries``, in blocks of queries and blocks of rows.

    Blocks are cut by hash and paired through their numbers, so a task holds
    one of each.
    """
    query_blocks = max(1, math.ceil(queries.count() / 1000))
    row_blocks = max(1, math.ceil(stored.count() / 20_000))
    left = _in_blocks(queries.select("q", "v"), "query_block", F.xxhash64("q"), query_blocks, "block", row_blocks)
    right = _in_blocks(stored.select("v", "ids"), "block", F.xxhash64("v"), row_blocks, "query_block", query_blocks)
    group = ["block", "query_block"]

    def scan(_, own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        parts = list(_scored(own, held, k))
        return pd.concat(parts) if parts else pd.DataFrame({"q": [], "vec_id": [], "score": []})

    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(scan, PAIRS)
    return settle(_top(found, k), "exhaustive").select("q", "vec_id", "score", "rank")
