"""The SimHash stage and its index against all pairs of fingerprints."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from daymart.llm import simhash


def brute_kept(rows):
    marks = [int.from_bytes(simhash.fingerprint(t, 3), "big") for _, t in rows]
    of = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if of[i] != of[j] and (marks[i] ^ marks[j]).bit_count() <= 3:
            old, new = of[i], of[j]
            of = [new if c == old else c for c in of]
    first = {}
    for (doc_id, _), c in zip(rows, of):
        first[c] = min(first.get(c, doc_id), doc_id)
    return sorted(first.values())


def test_one_document_of_each_group_stays(spark):
    draw = np.random.default_rng(3)
    texts = []
    for changes in (0, 1, 2, 4, 8, 16):
        for _ in range(8):
            base = [f"w{x}" for x in draw.integers(0, 9000, 400)]
            for _ in range(6):
                text = list(base)
                for p in draw.choice(400, changes, replace=False):
                    text[p] = f"new{draw.integers(0, 1 << 40)}"
                texts.append(" ".join(text))
    rows = [(int(k), texts[i]) for k, i in enumerate(draw.permutation(len(texts)))]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(r["doc_id"] for r in simhash.kept_documents(table).collect())
    assert got == brute_kept(rows) and 48 < len(got) < len(rows)


def test_registered_groups_go_through_the_index(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = simhash.fingerprints(docs, 3).toPandas()
    codes = np.unique(simhash._codes(rows["fingerprint"])[:, 0])
    for count in (len(codes), 235_000, 5 * 10**7):
        scheme = simhash.Exact.for_nodes(count)
        held = count / 2**scheme.leading
        assert held <= simhash.INDEXED_NODES and (held > simhash.INDEXED_NODES / 2 or not scheme.leading)
    # Leading bits of a block lead once it is turned to the front.
    bits = simhash.Exact(leading=5).tables(())[1]
    turned = simhash.block_first(codes, 1)
    assert (simhash._keys(codes[:, None], bits) == simhash._keys(turned[:, None], list(range(59, 64)))).all()
    entered = []
    near = simhash.GrayIndex.near
    monkeypatch.setattr(simhash.GrayIndex, "near", lambda self, q, limit: entered.append(len(self.codes)) or near(self, q, limit))
    i, j = simhash.link_group(turned[:, None], 3)
    labels = simhash._join(np.arange(len(codes)), i, j, [])
    a, b = np.triu_indices(len(codes), 1)
    close = np.bitwise_count(codes[a] ^ codes[b]) <= 3
    assert set(entered) == {len(codes)} and (labels[a[close]] == labels[b[close]]).all()


def test_no_group_grows_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_NODES", 20)
    largest = []
    link = simhash._link

    def watched(routed, *rest):
        largest.append(routed.groupBy("path", "key").count().agg(F.max("count")).first()[0] or 0)
        return link(routed, *rest)

    monkeypatch.setattr(simhash, "_link", watched)
    # All differ in the same few bits, so some keys of all levels hold them all.
    marks = np.random.default_rng(4).choice(1 << 12, 300, replace=False).tolist()
    nodes = spark.createDataFrame([(m, m.to_bytes(8, "big")) for m in marks], "node long, fingerprint binary")
    links = simhash.linked_nodes(nodes, simhash.Exact(), len(marks))
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    near = [(x, y) for x, y in itertools.combinations(marks, 2) if (x ^ y).bit_count() <= 3]
    assert near and all(got[x] == got[y] for x, y in near)
    assert max(largest) <= 60
