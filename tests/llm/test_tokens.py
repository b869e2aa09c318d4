import zlib

import numpy as np
import public_tokenizers
import pytest
from odd_rows import ODD_TEXTS
from tokenizers import Tokenizer

from daymart.llm import packing, tokens
from daymart.llm.packing import binary_lengths, pack, pieces
from daymart.llm.tokens import Encoder
from daymart.llm.wavelet import Shard, WaveletMatrix, BitPlane, shard_bytes, token_documents
from daymart.operators.scratch import settle

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def plain_ids(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name, spaced", [(WORD, False), (BYTE, True)])
def test_words_give_the_ids_of_whole_texts(documents, name, spaced, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3000)
    texts = [r["text"] for r in documents.select("text").collect()] + [t or "" for t in ODD_TEXTS]
    texts += ["\nA b.\nC", "a\n", " a ", "\n\nx", "x" * 500 + " y", "ÀÉ ß ǅ ΑΣ ﬁ K.", "don't it's"]
    encoder = Encoder(name, spaced)
    got = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encode_texts(encoder, texts)]
    assert got == plain_ids(name, texts)


def expected_index(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [np.array([*i, 2], "<u4").tobytes() for i in plain_ids(WORD, [t for _, t in rows])]
    out, start = [], 0
    for (doc_id, _), own in zip(rows, ids):
        out.append((doc_id, start, len(own) // 4, zlib.crc32(own)))
        start += len(own) // 4
    return out


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def by_start(rows):
    return sorted(rows, key=lambda r: r[1])


def test_shards_give_back_every_document(documents):
    got = as_rows(token_documents(documents, tokenizer=WORD, spaced=False, end_id=2))
    assert by_start(got) == expected_index([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()])


def test_shards_of_odd_rows(odd_documents, no_documents):
    got = by_start(as_rows(token_documents(odd_documents, tokenizer=WORD, spaced=False, end_id=2)))
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert got == expected_index(rows)
    assert as_rows(token_documents(no_documents, tokenizer=WORD, spaced=False, end_id=2)) == []


def test_a_shard_answers_without_being_expanded():
    draw = np.random.default_rng(3)
    parts = [draw.integers(0, 300, n).astype("<u4") for n in (500, 0, 1, 777)]
    shard = Shard(shard_bytes([1, 2, None, 4], [p.tobytes() for p in parts], 300))
    ids = np.concatenate(parts)
    assert shard.doc_ids == [1, 2, None, 4]
    assert shard.matrix.ids().tolist() == ids.tolist()
    assert [shard.matrix.access(i) for i in range(0, len(ids), 7)] == ids[::7].tolist()
    assert [shard.document(k).tolist() for k in range(4)] == [p.tolist() for p in parts]
    for token in (0, 17, 299, 1000):
        places = np.flatnonzero(ids == token)
        assert shard.matrix.count(token) == len(places)
        assert shard.matrix.count(token, 600) == int((places < 600).sum())
        assert [shard.matrix.find(token, k) for k in range(len(places))] == places.tolist()
    with pytest.raises(IndexError):
        shard.matrix.find(1000, 0)
    with pytest.raises(IndexError):
        shard.matrix.access(len(ids))


def test_rank_and_select_at_word_ends():
    bits = np.zeros(200, dtype=np.uint8)
    bits[[0, 63, 64, 127, 128, 199]] = 1
    plane = BitPlane(np.packbits(bits, bitorder="little"), 200)
    assert [int(plane.rank1(i)) for i in (0, 1, 63, 64, 65, 128, 199, 200)] == [0, 1, 1, 2, 3, 4, 5, 6]
    assert [plane.select(1, k) for k in range(6)] == [0, 63, 64, 127, 128, 199]
    assert plane.select(0, 0) == 1
    assert WaveletMatrix([], 0).ids().tolist() == []


def check_pieces(rows, docs):
    ids = {}
    for doc_id, text in docs:
        own = np.array([*plain_ids(BYTE, [text])[0], 1], "<u4").tobytes()
        ids.setdefault(doc_id, []).append(own)
    want = []
    for doc_id, copies in ids.items():
        for own in copies:
            start = 0
            for length in binary_lengths(len(own) // 4):
                part = own[4 * start : 4 * (start + length)]
                want.append((doc_id, start, length, zlib.crc32(part), len(own) // 4))
                start += length
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 for r in rows)
    by_id = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_id] == sorted((r["length"] for r in rows), reverse=True)


def test_pieces_are_binary_places(documents, odd_documents, no_documents):
    assert binary_lengths(2048 * 2 + 5) == [2048, 2048, 4, 1]
    for table in (documents, odd_documents):
        rows = pack(table, tokenizer=BYTE, spaced=True, end_id=1).collect()
        check_pieces(rows, [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
    assert pack(no_documents, tokenizer=BYTE, spaced=True, end_id=1).collect() == []


def test_ascii_letters_are_not_rewritten_after_a_space(monkeypatch):
    """Their byte letters are themselves; only other letters are written anew."""
    rewritten = []
    plain = Encoder._in_letters
    monkeypatch.setattr(Encoder, "_in_letters", lambda self, piece, space: rewritten.append(piece) or plain(self, piece, space))
    encoder = Encoder("byte_bpe_50k.json", True)
    text = "one zebra, naïve\nline ünder Cases"
    assert encoder.encode([text]) == [encoder._alone(text)]
    assert sorted(p.lstrip("Ġ") for p in rewritten) == ["naïve", "ünder"]


def test_letters_with_any_marks_are_told_by_their_pieces(monkeypatch):
    """The tokenizer itself is not asked for words whose letters and marks are pieces of their own."""
    asked = []
    plain = Encoder._encode
    monkeypatch.setattr(Encoder, "_encode", lambda self, words: asked.extend(words) or plain(self, words))
    texts = ["It was naïve&&& or (not) bar$$$ bar.%%% <|x Zoë*** a-b end###\nnew|| *** x.", "one bar$$$ bar's"]
    for name, spaced in ((WORD, False), (BYTE, True)):
        asked.clear()
        got = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encode_texts(Encoder(name, spaced), texts)]
        assert got == plain_ids(name, texts)
        assert not [w for w in asked if w.strip() in ("naïve&&&", "bar$$$", "bar.%%%", "end###", "\nnew||", "zoë***", "Zoë***")]


def test_pieces_carry_ids_only_where_asked(spark, documents, monkeypatch):
    few = documents.limit(7).select("doc_id", "text")
    bare = pieces(few, tokenizer=BYTE, spaced=True, end_id=1, with_ids=False)
    whole = pieces(few, tokenizer=BYTE, spaced=True, end_id=1)
    assert "ids" not in bare.columns and "ids" in whole.columns
    assert sorted(as_rows(bare)) == sorted(as_rows(whole.drop("ids")))
    # Batches for workers are small only while the pieces are stored.
    seen = []
    monkeypatch.setattr(packing, "settle", lambda df, label: seen.append(spark.conf.get(packing._BATCH_SETTING)) or settle(df, label))
    before = spark.conf.get(packing._BATCH_SETTING)
    assert pack(few, tokenizer=BYTE, spaced=True, end_id=1, with_ids=True).count() == bare.count()
    assert seen == ["2000"] and spark.conf.get(packing._BATCH_SETTING) == before


@pytest.mark.parametrize("name, spaced", [(WORD, False), (BYTE, True)])
def test_a_piece_is_encoded_once_whatever_stands_beside_it(name, spaced, monkeypatch):
    """Marks and digits are pieces of their own, so the letters before and after them are met again."""
    asked = []
    plain = Encoder._encode_pieces
    monkeypatch.setattr(Encoder, "_encode_pieces", lambda self, pieces: asked.extend(pieces) or plain(self, pieces))
    encoder = Encoder(name, spaced)
    texts = ["it was unheard, naïve7 and", "so unheard. (naïve) naïve- unheard12 (naïve", "an unheard/naïve unheard*** naïve***"]
    for text in texts:
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([text])] == plain_ids(name, [text])
    # With and without the space before them.
    assert len([p for p in asked if "unheard" in p]) == 1
    assert len([p for p in asked if "na" in p]) == 2


#: What pieces are cut at, what they may not be cut at, and special tokens.
BESIDE = [*"abTS019.,;-!#'*<|>\t\r\x00\x1c`", " ", "\n", " the", "é", "É", "ß", "×", "÷", "ª", "º", "²", " ", "\u0085", "İ"]
BESIDE += ["Σ", "中", "́", "̸", "　", "ɏ", "ɐ", "'s", "'LL", "Ā", "</w>", "", "<|endoftext|>", "<|ENDOFTEXT|>"]


@pytest.mark.parametrize("name, spaced", [(WORD, False), (BYTE, True)])
@pytest.mark.parametrize("kept", [tokens.KEPT_WORDS, 300])
def test_cut_texts_have_the_ids_of_whole_ones(name, spaced, kept, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", kept)
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(BESIDE, draw.integers(0, 9))) for _ in range(8000)]
    texts += [a + b + c for a in ("x", " ", "7") for b in BESIDE for c in BESIDE]
    texts += ["a" * 201 + "." * 300 + "é" * 150 + "7" * 250, "\n", " ", ""]
    encoder = Encoder(name, spaced)
    got = [ids for a in range(0, len(texts), 1000) for ids in encoder.encode(texts[a : a + 1000])]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == plain_ids(name, texts)
    assert encoder.encode([]) == []


@pytest.mark.parametrize("name, spaced", [(WORD, False), (BYTE, True)])
def test_the_store_of_pieces_stays_bounded(name, spaced, monkeypatch):
    """Pieces that came back stay when the store is emptied."""
    monkeypatch.setattr(tokens, "KEPT_WORDS", 40)
    encoder = Encoder(name, spaced)
    for k in range(30):
        texts = [f"the same and x{'abcdefghij'[k % 10]}{'klm'[k // 10]}{'nopqr'[j]} again" for j in range(5)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == plain_ids(name, texts)
        assert len(encoder.known) <= 40 and {b" same", b" and", b" again"} <= encoder.known.keys()


def test_a_pieces_last_letter_or_a_letter_behind_it_tells_its_end():
    """Many pieces go to the model as one stretch; nothing is merged across their ends."""
    pieces = ["unheard", " unheard", "of", " naïve", "é", "***", "7", " 7", "x" * 150, "the"]
    for name, spaced in ((WORD, False), (BYTE, True)):
        ids, counts = Encoder(name, spaced)._encode_pieces(pieces)
        got = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == plain_ids(name, pieces)


def test_shards_of_pieces_cut_at_marks_and_digits(spark):
    rows = [(1, "ab,ab.7 12é"), (2, ",ab ab\n\nab  7é"), (3, "<|ENDOFTEXT|> <|endoftext|>ab"), (4, "\n"), (5, "don't'S ÀB×c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = as_rows(token_documents(docs, tokenizer=WORD, spaced=False, end_id=2))
    assert by_start(got) == expected_index(rows)
