"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.operators.scratch import settle


def _pointers(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself, followed to where it points in turn.

    Pointers only go down, so following them ends; what is not reached in
    these steps is left to the next round.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    to = settle(both.groupBy("a").agg(F.least("a", F.min("b")).alias("r")), "pointers")
    for _ in range(2):
        behind = to.select(F.col("a").alias("r"), F.col("r").alias("next"))
        to = settle(to.join(behind, "r", "left").select("a", F.coalesce("next", "r").alias("r")), "pointers")
    return to


def _contract(edges: DataFrame, to: DataFrame) -> DataFrame:
    ends = edges.join(to.select("a", F.col("r").alias("ra")), "a")
    ends = ends.join(to.select(F.col("a").alias("b"), F.col("r").alias("rb")), "b")
    pair = ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
    return pair.filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node that has an edge in ``edges`` (a, b).

    Nodes of one component share a root; which node it is has no meaning. Each
    round shrinks the graph to its stars' centres, so rounds grow with the
    logarithm of the longest path, and each is written before the next.
    """
    left = settle(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        to = _pointers(left)
        if labels is None:
            labels = to.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            moved = labels.join(to.select(F.col("a").alias("root"), "r"), "root", "left")
            labels = moved.select("node", F.coalesce("r", "root").alias("root"))
        left = settle(_contract(left, to), "edges")
        if left.isEmpty():
            return settle(labels, "roots")
        labels = settle(labels, "labels")
