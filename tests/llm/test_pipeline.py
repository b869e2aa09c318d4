import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from test_filters import brute_components, counts_of
from test_mixing_sharding_ann import brute_targets
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        found = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert found and found <= ids
        if name != "packing":
            assert out.columns == columns
        docs, ids = out, found
    assert docs.filter("length & (length - 1) <> 0").count() == 0


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    n, ids = rows.count(), rows.select("sequence_id").distinct().count()
    assert n == ids > 0


def plain(table):
    return [r.asDict() for r in table.collect()]


def test_each_stage_does_to_its_input_what_plain_python_does(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = plain(docs), plain(out)
        docs = out

    # Rules: what the base rejects is gone, and rows that stay are unchanged.
    before, after = steps["quality_rules"]
    for r in after:
        n, _, _, _, repeated = counts_of(r["text"])
        assert n >= 20 and 100 * repeated <= 30 * n
    whole = Counter(map(repr, before))
    assert not Counter(map(repr, after)) - whole and len(after) > 0.5 * len(before)

    before, after = steps["toxicity"]
    assert not Counter(map(repr, after)) - Counter(map(repr, before)) and len(after) > 0.5 * len(before)

    # Near-duplicates: the smallest id of each component, its row unchanged.
    before, after = steps["simhash_near_duplicates"]
    component = {row[0]: row[2] for row in brute_components([(r["doc_id"], r["text"]) for r in before])}
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if component[r["doc_id"]] == r["doc_id"])

    # The mix: words of each source come to its target, none above two epochs.
    before, after = steps["mixture"]
    words, taken, sizes = {}, Counter(), Counter()
    for r in before:
        words[r["doc_id"]] = counts_of(r["text"])[0]
        sizes[r["source"]] += words[r["doc_id"]]
    want, own, texts = brute_targets(sizes), Counter(), {r["doc_id"]: r["text"] for r in before}
    for r in after:
        n = counts_of(r["text"])[0]
        taken[r["source"]] += n
        own[r["doc_id"]] += n
        assert r["text"] == texts[r["doc_id"]] or texts[r["doc_id"]].split()[:n] == r["text"].split()
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert all(n <= 2 * words[d] for d, n in own.items())

    # Packing: each row's ids, whole, in pieces of powers of two.
    before, after = steps["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for r in before:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        start = 0
        while start < len(ids):
            rest = len(ids) - start
            length = 2048 if rest >= 2048 else 1 << (rest.bit_length() - 1)
            data = np.array(ids[start : start + length], dtype="<u4").tobytes()
            expected[r["doc_id"], start, length, zlib.crc32(data), len(ids), data] += 1
            start += length
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")
    assert Counter(tuple(bytes(r[n]) if n == "ids" else r[n] for n in names) for r in after) == expected
    assert sorted(r["sequence_id"] for r in after) == list(range(len(after)))
