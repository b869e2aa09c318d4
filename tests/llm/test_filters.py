import base64
import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from odd_rows import ODD_TEXTS
from pyspark.sql import functions as F

from daymart.llm import simhash, warc
from daymart.llm.licenses import MIN_COVERAGE, NOTICES, PHRASES, SHIFT, WHOLE_LICENCES, LicenseIndex, scan_documents
from daymart.llm.quality_rules import Condition, Rule, fit_rules, judge, kept_documents, learn_rules, measure, verdict
from daymart.llm.toxicity import (
    Field,
    Tagger,
    _WORD,
    _forward_backward,
    _stretches,
    features_of,
    fit,
    flag_documents,
    keep_clean,
    score_documents,
)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def id_key(doc_id):
    return (doc_id is None, doc_id or 0)


# Rules


def counts_of(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    marked = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_are_those_of_plain_python(documents, odd_documents, no_documents):
    for table in (documents, odd_documents):
        got = sorted(map(tuple, measure(table).select("doc_id", *COUNTS).collect()), key=lambda r: (id_key(r[0]), r[1:]))
        rows = [(r["doc_id"], *counts_of(r["text"])) for r in table.select("doc_id", "text").collect()]
        assert got == sorted(rows, key=lambda r: (id_key(r[0]), r[1:]))
    assert measure(no_documents).collect() == []


def test_rules_find_what_makes_rows_bad(spark):
    rows = [(k, int(k % 10 == 0), 30 + k % 7, 150, 40 if k % 10 == 0 else 0) for k in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, bad int, n_words long, word_chars long, n_symbols long")
    zero = {c: F.lit(0).cast("long") for c in ("n_lines", "n_dup_lines", "n_upper", "n_digits", "n_marks", "n_repeat_words")}
    rules = learn_rules(table.withColumns(zero))
    assert [c.feature for r in rules for c in r.conditions] == ["symbol_rate"]
    assert rules[0].conditions[0].above and 0 <= rules[0].conditions[0].threshold < 0.2


def test_a_list_is_ordered(spark):
    rules = [Rule([Condition("words", True, 5)]), Rule([Condition("words", True, 2), Condition("words", False, 10)])]
    table = spark.createDataFrame([(1, 7), (2, 4), (3, 2)], "doc_id long, n_words long")
    assert [r[0] for r in table.orderBy("doc_id").select(verdict(rules)).collect()] == [1, 2, None]


def test_odd_rows_are_judged(odd_documents, no_documents, odd_labels):
    rules = fit_rules(odd_documents, odd_labels)
    assert judge(no_documents, rules).collect() == []
    assert fit_rules(odd_documents, odd_labels.limit(0)) == []
    kept = kept_documents(odd_documents, [])
    assert kept.columns == odd_documents.columns
    assert [r["doc_id"] for r in kept.collect()] == [11]


def test_rules_run_without_python(documents, labels):
    plan = judge(documents, fit_rules(documents, labels))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Toxicity


def brute_marginals(tagger, n, places, found):
    score = dict(zip(places, found))
    moves = np.log(tagger.move)
    total, hot = 0.0, dict.fromkeys(places, 0.0)
    for tags in itertools.product((0, 1), repeat=n):
        log = 0.0
        for t, tag in enumerate(tags):
            log += moves[tags[t - 1] if t else 0, tag]
            log += tagger.model.emission(score.get(t, ())) if tag else 0.0
        weight = np.exp(log)
        total += weight
        for p in places:
            hot[p] += weight * tags[p]
    return [hot[p] / total for p in places]


def test_marginals_are_those_of_all_tag_sequences():
    model = Field({"a": 0, "b": 1}, np.array([3.0, -1.0]), -1.2, np.array([[0.3, -0.7], [0.2, 0.9]]))
    tagger = Tagger(model)
    places, found = [1, 2, 6, 9], [(0,), (1,), (0, 1), (0,)]
    assert tagger.marginals(11, places, found) == pytest.approx(brute_marginals(tagger, 11, places, found), abs=1e-12)


def test_words_beside_a_stretch_keep_their_features_and_tags():
    places = list(range(3, 43))
    found, tags = [(p,) for p in places], [p % 2 for p in places]
    cut = list(_stretches(places, found, 50, tags))
    assert len(cut) == 3
    for own, own_tags in cut:
        assert [t for f, t in zip(own, own_tags) if f] == [f[0] % 2 for f in own if f]
    # Twenty words: sixteen of the stretch and four on either side, featured as they are.
    assert [f[0] for f in cut[1][0]] == list(range(15, 39))


def test_counted_stretches_weigh_as_often_as_they_occur():
    scores, mask = np.array([[0.3, -1.0, 0.7], [1.1, 0.2, 0.0]]), np.array([[True] * 3, [True, True, False]])
    moves = np.array([[0.1, -0.4], [0.3, 0.2]])
    counted = _forward_backward(scores, mask, moves, np.array([3.0, 1.0]))[2]
    rows = [0, 0, 0, 1]
    assert counted == pytest.approx(_forward_backward(scores[rows], mask[rows], moves, np.ones(4))[2])


def test_held_out_toxic_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = flag_documents(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    # Some labels of this table have nothing in the text that shows them.
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    assert all(r["toxic"] for r in rows if r["predicted"])
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_used(documents, labels):
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(map(tuple, flag_documents(documents, x).select("doc_id", "score").collect())) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_odd_rows_are_scored(odd_documents, no_documents, odd_labels):
    for labels in (odd_labels, odd_labels.limit(0), odd_labels.filter("toxic = 1")):
        model = fit(odd_documents, labels)
        rows = score_documents(odd_documents, model).collect()
        assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert score_documents(no_documents, model).collect() == []
        assert keep_clean(odd_documents, model).columns == odd_documents.columns


def test_spans_name_the_words():
    model = Field({"bad": 0}, np.array([12.0]), -6.0)
    tagger = Tagger(model)
    text = "Some BAD bad words, bad."
    _, places, _, marginals = tagger.tag(text)
    assert [text[a:b] for a, b, _ in tagger.spans(text, places, marginals)] == ["BAD bad", "bad"]
    text = "\u0130\u0130\u0130 words here Bad end \u0130bad bad"
    _, places, _, marginals = tagger.tag(text)
    assert [text[a:b] for a, b, _ in tagger.spans(text, places, marginals)] == ["Bad", "bad"]
    assert features_of("abcdefgh") == ["abcdefgh", "abcd-", "abcde-", "abcdef-"]
    assert _WORD.findall("a1b") == ["a", "b"]


# Licences


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(labels))


def test_base_phrases_are_those_of_plain_python(spark, odd_documents, no_documents):
    texts = ["mit license mit license apache license", "MIT-License; the GNU General  Public\nLicense", "general public", "é mit licénse license"]
    texts += ["x " * 400 + "apache license " + "y " * 3 + "general public license mit", *ODD_TEXTS]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:6] for r in scan_documents(table).collect()}
    assert got == {k: brute_base(t) for k, t in enumerate(texts)}
    assert scan_documents(odd_documents).count() == odd_documents.count()
    assert scan_documents(no_documents).collect() == []


def test_notices_need_their_key_phrase(spark):
    rows = [
        (0, "some words here. Licensed under CC BY-NC 4.0. more"),
        (1, "Licensed under the Apache License, Version 2.0."),
        (2, "licensed under the version 2 0 of nothing at all"),
        (3, "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice"),
    ] + [(k, "plain words under the version of some text") for k in range(4, 60)]
    found = {r["doc_id"]: r for r in scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0]["labels"] == "cc-by-nc-4.0" and found[0]["base_labels"] == ""
    assert found[1]["labels"] == "apache,apache-2.0" and found[1]["base_labels"] == "apache"
    assert found[2]["labels"] == "" and found[2]["score"] == 0
    assert found[3]["labels"] == "bsd" and 0.75 <= found[3]["score"] <= 1


def brute_notices(texts):
    """Labels and score of each text: every notice laid on every place."""
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    seen = Counter(w for own in words for w in set(own))
    idf = lambda w: np.log((len(texts) + 1) / (seen[w] + 1)) + 0.01
    out = []
    for own, text in zip(words, texts):
        labels = set(filter(None, brute_base(text)[4].split(",")))
        score = 1.0 if labels else 0.0
        for label, key, notice in NOTICES + WHOLE_LICENCES:
            notice, key = notice.split(), key.split()
            for start in range(-len(notice), len(own)):
                near = own[max(0, start - SHIFT) : max(0, start + len(notice) + SHIFT)]
                if not any(near[i : i + len(key)] == key for i in range(len(near))):
                    continue
                covered = sum(idf(w) for q, w in enumerate(notice) if w in own[max(0, start + q - SHIFT) : max(0, start + q + SHIFT + 1)])
                share = covered / sum(map(idf, notice))
                if share >= MIN_COVERAGE:
                    labels.add(label)
                    score = max(score, min(1.0, share))
        out.append((",".join(sorted(labels)), score))
    return out


def changed_notices(n):
    """Licences with words left out, put in and replaced, one after the other."""
    draw = random.Random(5)
    bodies = [text.split() for _, _, text in NOTICES + WHOLE_LICENCES]
    for k in range(n):
        words = []
        for body in draw.sample(bodies, 1 + k % 3):
            body = list(body)
            for _ in range(draw.randint(0, 1 + len(body) // 6)):
                at = draw.randrange(len(body))
                body[at : at + 1] = draw.choice([[], [body[at], "the"], [body[at], "license"], ["other"]]) or []
                body = body or ["none"]
            words += body + draw.choices(["some", "software", "the", "copy"], k=draw.randint(0, 9))
        yield " ".join(words)


def test_labels_and_scores_are_those_of_every_place(spark, odd_documents):
    odd = [r["text"] for r in odd_documents.select("text").collect()]
    texts = [*changed_notices(60), *(t for t in odd if len(t or "") < 5_000), *["plain words of some text"] * 40]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in scan_documents(table).collect()}
    for k, (labels, score) in enumerate(brute_notices(texts)):
        assert got[k] == (labels, pytest.approx(score, abs=1e-9))
    assert len({labels for labels, _ in got.values()}) > 20


def test_only_beginnings_where_enough_weight_meets_are_verified():
    index = LicenseIndex({b"software": 900, b"the": 990, b"license": 500}, 1_000)
    text = " ".join(["software the license permission granted charge"] * 50 + ["released under the mit license"])
    checked = []
    index._coverage = lambda words, t, start: checked.append((t, start)) or 0.0
    index.scan(text)
    assert {index.templates[t].label for t, _ in checked} <= {"mit-notice"}
    assert len(checked) <= 2 * SHIFT + 1
    # A text without a notice's words looks nothing up.
    assert index._lookups(index.vocabulary.intersection([b"software", b"the"])) == ({}, {})


# SimHash


def brute_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    marks = [brute_fingerprint(t) for _, t in rows]
    of = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= 3 and of[i] != of[j]:
            old, new = of[i], of[j]
            of = [new if x == old else x for x in of]
    first = {}
    for (doc_id, _), c in zip(rows, of):
        if doc_id is not None:
            first[c] = min(first.get(c, doc_id), doc_id)
    return sorted(((d, f"{m:016x}", first.get(c)) for (d, _), m, c in zip(rows, marks, of)), key=str)


def test_components_are_those_of_all_pairs(spark, odd_documents, no_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for table in (docs, odd_documents.filter("doc_id is null or doc_id <> 11")):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        got = [tuple(r) for r in simhash.simhash_components(table).collect()]
        assert sorted(got, key=str) == brute_components(rows)
    assert simhash.simhash_components(no_documents).collect() == []


@pytest.mark.parametrize("limit, words", [(3, 1), (50, 4)])
def test_the_index_links_what_all_pairs_link(limit, words):
    draw = np.random.default_rng(5)
    seeds = draw.integers(0, 1 << 63, (60, words), dtype=np.uint64)
    codes = seeds[draw.integers(0, 60, 900)]
    for _ in range(3 if words == 1 else 30):
        codes = codes ^ (np.uint64(1) << draw.integers(0, 64, codes.shape).astype(np.uint64))
    apart = np.bitwise_count(codes[:, None] ^ codes[None]).sum(axis=2)
    index = simhash.GrayIndex(codes)
    q, place = index.near(index.codes, limit)
    assert len(q) == int((apart <= limit).sum())
    a, b = simhash.link_group(codes, limit)
    assert (apart[a, b] <= limit).all()

    def roots(x, y):
        return simhash._join(np.arange(len(codes)), x, y, [])

    i, j = np.nonzero(np.triu(apart <= limit, 1))
    want, got = roots(i, j), roots(a, b)
    assert [want.tolist().index(x) for x in want] == [got.tolist().index(x) for x in got]


def test_crowded_keys_are_dealt_out_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_NODES", 6)
    draw = np.random.default_rng(6)
    marks = np.unique(np.concatenate([draw.integers(0, 1 << 63, 40), 7 ^ (1 << draw.integers(0, 63, 200)) ^ (1 << draw.integers(0, 63, 200))]))
    rows = [(int(m), int(m).to_bytes(8, "big")) for m in marks]
    nodes = spark.createDataFrame(rows, "node long, fingerprint binary")
    links = simhash.linked_nodes(nodes, simhash.Exact(), len(rows))
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    near = [(x, y) for x, y in itertools.combinations(marks.tolist(), 2) if (x ^ y).bit_count() <= 3]
    assert near and all(got[x] == got[y] for x, y in near)
    assert set(got) == {x for pair in near for x in pair}


def test_one_of_each_group_stays(spark, odd_documents, no_documents):
    draw = np.random.default_rng(8)
    base = [f"word{x}" for x in draw.integers(0, 5000, 400)]
    near = [*base]
    near[100], near[300] = "other", "another"
    far = [w if k % 3 else f"new{k}" for k, w in enumerate(base)]
    rows = [(3, " ".join(base)), (1, " ".join(near)), (2, " ".join(far)), (9, " ".join(base)), (3, " ".join(base))]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("copies", F.lit(1))
    kept = simhash.kept_documents(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert simhash.kept_documents(no_documents).collect() == []
    once = simhash.kept_documents(odd_documents.select("doc_id", "text")).collect()
    assert sorted((r["doc_id"] for r in once), key=id_key) == [0, 3, 4, 5, 7, 8, 9, 10, 11, None]


# WARC


def brute_records(rows):
    digests = [base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for _, h in rows]
    first = {}
    for (page, _), d in zip(rows, digests):
        if page is not None:
            first[d] = min(first.get(d, page), page)
    out = []
    for (page, html), d in zip(rows, digests):
        later = d in first and page != first[d]
        out.append((page, len((html or "").encode()), d, "revisit" if later else "response", first[d] if later else None))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_archives_give_back_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    got = sorted([tuple(r) for r in warc.archived_pages(pages).select(*COLUMNS).collect()], key=str)
    assert got == brute_records(rows)


def test_odd_pages(spark, tmp_path):
    gzip_inside = "".join(map(chr, draw_bytes())) + "\x1f\x8b\x08" * 50
    rows = [(1, "u", None), (2, "ü /\r\n x", ""), (3, None, "é" * 10), (4, "u", "é" * 10), (4, "u", "é" * 10), (None, "u", "solo")]
    rows += [(None, None, "é" * 10), (7, "u", gzip_inside), (8, "u", "big " * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    want = brute_records([(p, h) for p, _, h in rows])
    folder = f"file://{tmp_path}/warc"
    warc.write_warc(pages.coalesce(1), folder)
    for size in (50, 333, 10_000, 1 << 21):
        got = [tuple(r) for r in warc.read_warc(spark, folder, range_bytes=size).select(*COLUMNS).collect()]
        assert sorted(got, key=str) == want
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_warc(spark, folder).filter("page_id in (7, 8)").collect()}
    assert payloads == {7: gzip_inside, 8: "big " * 300_000}
    assert warc.archived_pages(pages.limit(0)).collect() == []


def draw_bytes():
    return np.random.default_rng(9).integers(1, 256, 3000).tolist()
