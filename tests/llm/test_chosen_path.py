"""Near-duplicates by chosen paths, against SQL and all pairs."""

import itertools

import numpy as np
import pytest
import sql_check

from daymart.llm import chosen_path
from daymart.llm.queries import ORACLE_SQL, QUERIES


def shingles_of(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [shingles_of(t) for _, t in rows]
    of = list(range(len(rows)))

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
            of[root(i)] = root(j)
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(k)] = min(ids.get(root(k), doc_id), doc_id)
    return sorted((d, len(s), ids.get(root(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets)))


def found(table):
    rows = chosen_path.near_components(table).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


def test_registered_query_is_that_of_sql(spark):
    sf = "/root/testdata/sf0.001"
    with sql_check.connect(sf) as connection:
        sql_check.assert_same(QUERIES["op11_chosen_path"](spark, sf), connection, ORACLE_SQL["op11_chosen_path"])


def test_large_families_are_those_of_all_pairs(spark, monkeypatch):
    # Families of which most members are just below the limit to each other, in nodes that branch and end in blocks.
    monkeypatch.setattr(chosen_path, "NODE_ROWS", 24)
    monkeypatch.setattr(chosen_path, "_SLICE", 40)
    draw = np.random.default_rng(5)
    texts = []
    for _ in range(3):
        base = [f"w{x}" for x in draw.integers(0, 9000, 150)]
        for _ in range(100):
            text = list(base)
            for p in draw.choice(150, draw.integers(0, 9), replace=False):
                text[p] = f"n{draw.integers(0, 1 << 40)}"
            texts.append(" ".join(text))
    rows = [(int(i), texts[k]) for i, k in enumerate(draw.permutation(len(texts)))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    none = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in chosen_path.near_components(odd_documents).collect()]
    plain = [(d, t) for d, t in rows if d is not None and not (t or "").startswith("A\xa0")]
    known = {(d, n, c) for d, n, c in brute(plain)}
    assert {x for x in none if x[0] is not None and (x[0], rows[x[0]][1]) in plain} == known
    assert [x for x in none if x[0] is None] == [(None, 1, None)] * 2
    assert chosen_path.near_components(no_documents).collect() == []


def test_pairs_at_the_limit_meet_as_often_as_stated():
    draw = np.random.default_rng(2)
    hashes = [draw.integers(0, 1 << 64, 185, dtype=np.uint64) for _ in range(1500)]
    # 170 and 185 of 200 of either: a similarity of 0.85.
    a, b = chosen_path.minwise([h[:185] for h in hashes]), chosen_path.minwise([np.concatenate([h[15:], h[:0]]) for h in hashes])
    alike = (a == b).mean()
    assert abs(alike - 170 / 185) < 0.01
    places = chosen_path._root_places(chosen_path.trees_for())
    met = (a == b)[:, [p for _, p in places]].any(axis=1)
    assert met.mean() >= 0.999
    assert ((a == b).sum(axis=1) >= chosen_path.least_agreeing()).all()
    chances = [chosen_path.meeting_chance(d) for d in range(5)]
    assert chances == sorted(chances, reverse=True)
    assert 1 - (1 - chances[chosen_path.DEPTH]) ** chosen_path.trees_for() >= chosen_path.RECALL


@pytest.mark.parametrize("sizes", [(3, 5, 2), (40,) * 20])
def test_shared_shingles(sizes, monkeypatch):
    monkeypatch.setattr(chosen_path, "_COLUMNS", 7)
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, n)) for n in sizes]
    want = [[len(set(x) & set(y)) for y in sets] for x in sets]
    got = chosen_path.shared_shingles(sets)
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()
