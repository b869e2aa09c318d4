"""Token alignment against whole encoding and all overlapping pairs."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from odd_rows import ODD_TEXTS
from tokenizers import Tokenizer

from daymart.llm import alignment
from daymart.llm.tokens import _byte_letters

MORE = [
    "a\n\nb",
    "x <|endoftext|> y<|endoftext|>",
    "tab\tx",
    " lead",
    "trail ",
    "ﬁ Å é 　x",
    "日本語 テスト ǅ",
    "a\x00b nul \x1c x",
    "<s> </s> <unk>",
    "a\x85b",
    "line\nbreak and\nmore",
]


def brute(rows):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {letter: byte for byte, letter in _byte_letters().items()}
    docs = []
    for doc_id, text in rows:
        found = (doc_id, 0, 0, 0, [], "")
        if text:
            encoded = a_model.encode(" " + text, add_special_tokens=False)
            a, a_bytes = encoded.ids, [bytes(letters[c] for c in t) for t in encoded.tokens]
            b = b_model.encode(text)
            pieces = [b_model.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                found = (doc_id, *_aligned(a, a_bytes, b, b_bytes))
        docs.append(found)
    counts = Counter(pair for d in docs for pair in set(d[4]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (d, n_a, n_b, groups, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), shown)
        for d, n_a, n_b, groups, links, shown in docs
    ]


def _spans(parts):
    at, out = 0, []
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def _aligned(a, a_bytes, b, b_bytes):
    spans_a, spans_b = _spans(a_bytes), _spans(b_bytes)
    cuts = sorted({end for _, end in spans_a} & {end for _, end in spans_b})
    groups, links, i, j = [], [], 0, 0
    for cut in cuts:
        i0, j0 = i, j
        while i < len(a) and spans_a[i][1] <= cut:
            i += 1
        while j < len(b) and spans_b[j][1] <= cut:
            j += 1
        groups.append(f"{','.join(map(str, a[i0:i]))}|{','.join(map(str, b[j0:j]))}")
        links += [
            (a[m], b[n]) for m in range(i0, i) for n in range(j0, j) if spans_a[m][0] < spans_b[n][1] and spans_b[n][0] < spans_a[m][1]
        ]
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def aligned(df):
    return Counter(tuple(r) for r in alignment.align_documents(df).collect())


def test_documents_are_those_of_all_pairs(spark, documents, no_documents):
    odd = [*enumerate([*ODD_TEXTS, *MORE], 10**6), (None, "x y"), (None, "x y")]
    table = documents.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = [tuple(r) for r in table.collect()]
    assert aligned(table) == Counter(brute(rows))
    assert alignment.align_documents(no_documents).collect() == []


def test_other_columns_are_not_read(odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert aligned(odd_documents) == Counter(brute(rows))


@pytest.mark.parametrize("kept", [10, 200])
def test_a_small_store_gives_the_same(monkeypatch, kept):
    texts = [" ".join(f"w{(7 * k + i) % 90}x{i % 5}" for i in range(60)) + "\nend" for k in range(30)]
    whole = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    want = [[part.tolist() if hasattr(part, "tolist") else part for part in whole.whole(t)] for t in texts]
    monkeypatch.setattr(alignment, "KEPT_WORDS", kept)
    small = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    for k in range(0, 30, 3):
        got = alignment.align_texts(small, texts[k : k + 3])
        assert [[part.tolist() if hasattr(part, "tolist") else part for part in x] for x in got] == want[k : k + 3]
