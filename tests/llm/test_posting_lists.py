"""Neighbours from lists: which are read, how even they are, and what is found."""

import numpy as np

from daymart.llm import ann


def brute(points, q):
    score = ann.inner(points[q : q + 1], points)[0]
    return [i for i in np.lexsort([np.arange(len(points)), -score]) if i != q][:20]


def found_by(spark, points, **options):
    table = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(table, **options).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    return {q: [found[r] for r in range(1, 21)] for q, found in got.items()}


def far_apart():
    draw = np.random.default_rng(3)
    return draw.normal(size=(2400, 16)) * draw.pareto(2.5, (2400, 1)).clip(0.05, 30)


def clustered(rows=6000, centres=150):
    draw = np.random.default_rng(5)
    middle = draw.normal(size=(centres, 24))
    points = middle[draw.integers(0, centres, rows)] + draw.normal(size=(rows, 24)) * 0.12
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def test_all_lists_give_the_neighbours_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 8)
    points = far_apart()
    got = found_by(spark, points, recall=1.0)
    assert len(got) == 120
    assert all(found == brute(points, q) for q, found in got.items())


def test_lengths_far_apart_keep_the_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 8)
    points = far_apart()
    got = found_by(spark, points)
    assert len(got) == 120
    assert np.mean([len(set(found) & set(brute(points, q))) / 20 for q, found in got.items()]) >= 0.9


def test_few_lists_are_read_and_hold_the_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 40)
    points = clustered()
    got = found_by(spark, points)
    assert len(got) == 300
    assert np.mean([len(set(found) & set(brute(points, q))) / 20 for q, found in got.items()]) >= 0.9
    centroids = ann.fit_centroids(points, len(points), 1.0)
    read = centroids.within(centroids.lift(points[::20], query=True))
    assert len(centroids.points) == 150 and read.mean() < 0.2


def test_lists_are_even_although_clusters_are_not():
    draw = np.random.default_rng(8)
    middle = draw.normal(size=(20, 24))
    share = np.where(draw.random(6000) < 0.3, 0, draw.integers(0, 20, 6000))
    points = middle[share] + draw.normal(size=(6000, 24)) * 0.6
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids = ann.fit_centroids(points, 200 * 60, 1.0)
    own = centroids.distances(centroids.lift(points)).argmin(axis=1)
    sizes = np.bincount(own, minlength=60)
    assert len(centroids.points) == 60 and sizes.max() <= 2 * sizes.mean()


def test_the_walk_widens_until_the_ratio_is_passed():
    points = clustered()
    centroids = ann.fit_centroids(points, 200 * 400, 1.0)
    asked = centroids.lift(points[:200], query=True)
    dist = centroids.distances(asked)
    for ratio in (1.0, 1.5, 3.0):
        centroids.ratio = ratio
        want = dist <= ratio * dist.min(axis=1, keepdims=True)
        assert (centroids.within(asked) & want).sum() >= 0.97 * want.sum()
