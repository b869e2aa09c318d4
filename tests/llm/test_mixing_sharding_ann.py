import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymart.llm import ann, sharding
from daymart.llm.mixing import SEED, mix, mixed_documents
from daymart.llm.sharding import place_cells, shard_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(table, *names):
    return [tuple(r) for r in table.select(*names).collect()]


# Mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def check_mix(table):
    rows = rows_of(table, "doc_id", "text", "source")
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    got = mix(table, keep=("source",)).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mix(table.repartition(5), keep=("source",)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    return got


def test_sources_come_to_their_targets(documents):
    got = check_mix(documents)
    order = defaultdict(list)
    texts = {i: hashlib.md5(t.encode()).hexdigest() for i, t in rows_of(documents, "doc_id", "text")}
    for r in got:
        name = f"{SEED}:{r['doc_id']}:{texts[r['doc_id']]}"
        order[r["source"]].append((hashlib.md5(name.encode()).hexdigest(), r["size"], r["taken"], r["target"], r["source_size"]))
    for rows in order.values():
        whole = int(rows[0][3] // rows[0][4])
        extra = [t - whole * s for _, s, t, _, _ in sorted(rows)]
        sizes = [s for _, s, *_ in sorted(rows)]
        full = [e == s for e, s in zip(extra, sizes) if s]
        assert full == sorted(full, reverse=True) and sum(0 < e < s for e, s in zip(extra, sizes)) <= 1


def test_one_id_of_many_rows_is_spread_over_buckets(spark):
    rows = [(7, f"text {k} " * (1 + k % 5), "hot") for k in range(6000)] + [(None, f"more {k}", "hot") for k in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(table)
    order = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.lit("7"), F.md5("text")))
    crowded = table.filter("doc_id = 7").groupBy(F.substring(order, 1, 3)).count().agg(F.max("count")).first()[0]
    assert crowded < 20


def test_odd_rows_are_mixed(odd_documents, no_documents):
    check_mix(odd_documents)
    assert mix(no_documents).collect() == []


def test_the_mix_holds_the_words_taken(odd_documents, no_documents):
    out = mixed_documents(odd_documents)
    assert out.columns == odd_documents.columns
    words = sum(len(WORD.findall(r["text"])) for r in out.select("text").collect())
    assert words == mix(odd_documents).agg(F.sum("taken")).first()[0]
    assert mixed_documents(no_documents).collect() == []


# Shards


def check_shards(table, shards=24):
    rows = rows_of(table, "doc_id", "text")
    got = shard_documents(table, shards=shards).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_shards_are_near_equal(spark, documents, odd_documents, no_documents):
    check_shards(documents)
    check_shards(odd_documents)
    assert shard_documents(no_documents).collect() == []
    rows = [(k, "hot text " * 20 if k % 3 == 0 else f"text {k} " * (k % 50)) for k in range(9000)]
    got = check_shards(spark.createDataFrame(rows, "doc_id long, text string"))
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    mean = sum(loads.values()) / 24
    assert max(loads.values()) < 1.02 * mean and min(loads.values()) > 0.95 * mean


@pytest.mark.parametrize("name", [None, 5])
def test_copies_without_ids_of_their_own_are_spread(spark, name):
    rows = [(name if k % 3 == 0 else k, "hot text " * 20 if k % 3 == 0 else f"text {k} " * (k % 50)) for k in range(30_000)]
    got = check_shards(spark.createDataFrame(rows, "doc_id long, text string"))
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    mean = sum(loads.values()) / 24
    assert max(loads.values()) < 1.02 * mean and min(loads.values()) > 0.95 * mean


def test_equal_texts_stay_together_unless_hot(spark):
    rows = [(k, f"copied text {k % 2000}") for k in range(8000)]
    got = check_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=4)
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_another_shard_moves_little():
    draw = np.random.default_rng(4)
    cells = [(k, int(draw.integers(0, 1 << 63)) * 2, int(s)) for k, s in enumerate(draw.integers(1, 100, 20_000))]
    before, after = place_cells(cells, 24), place_cells(cells, 25)
    loads = Counter()
    for cell, _, size in cells:
        loads[before[cell]] += size
    mean = sum(loads.values()) / 24
    assert max(loads.values()) <= mean * (1 + sharding.SLACK) + 50
    moved = sum(before[c] != after[c] for c, _, _ in cells) / len(cells)
    assert moved < 0.3
    assert place_cells(cells[::-1], 24) == before


# Neighbours


def brute_nearest(rows, k=20, every=20):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = [i for i, _ in good]
    m = np.array([v for _, v in good], dtype=np.float64)
    out = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            score = ann.inner(m[n : n + 1], m)[0]
            order = sorted((-s, j) for s, j in zip(score, ids) if j != i)[:k]
            out[i] = [(j, -s) for s, j in order]
    return out


def by_query(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


def test_neighbours_are_nearly_those_of_all_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute_nearest(rows_of(table, "vec_id", "embedding"))
    got = by_query(ann.nearest(table).collect())
    assert got.keys() == want.keys()
    found = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(found) >= 0.9 and all(len(g) == 20 for g in got.values())
    true = {q: dict(w) for q, w in want.items()}
    assert all(true[q].get(v, s) == s for q, g in got.items() for v, s in g)


def test_odd_vectors_take_no_part(spark):
    draw = np.random.default_rng(2)
    rows = [(k, [float(x) for x in np.float32(draw.normal(size=4))]) for k in range(90)]
    hot = rows[40][1]
    rows += [(k, hot) for k in range(100, 200)] + [(40, hot), (40, hot)]
    rows += [(220, None), (240, [0.0] * 4), (260, [1.0, None, 0.0, 0.0]), (280, [float("nan")] * 4), (300, [float("inf"), 0.0, 0.0, 0.0]), (None, hot)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got, want = by_query(ann.nearest(table).collect()), brute_nearest(rows)
    assert {q: [v for v, _ in g] for q, g in got.items()} == {q: [v for v, _ in w] for q, w in want.items()}
    assert ann.nearest(table.limit(0)).collect() == []
    few = ann.nearest(table.filter("vec_id < 5")).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in few) == [(0, k) for k in (1, 2, 3, 4)]
