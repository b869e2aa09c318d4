"""Alignment of the tokens of two tokenizers, by divide and conquer at shared cuts.

Both tokenizers cut the same bytes. Where a token of A and a token of B end at
one byte, the text falls into two parts that can be aligned by themselves. So
an interval of tokens is split at a common end near its middle, found by
bisecting the ends of B for an end of A, and both halves are split again; an
interval without a common end inside is a leaf group. Tokens of a leaf are
linked when their bytes overlap.

Neither vocabulary has a token that goes on after a space or line break between
two letters, so such a place is a common end at any rate, and what lies between
two of them is aligned once in a worker and remembered. Texts with other white
space, or more of it in a row, are encoded and split whole.

How many documents link a pair of ids is counted by built-in functions over
the distinct pairs of each document, and joined back: broadcast when the
counts are small by a check of their size, otherwise by a shuffle in which
pairs of very many documents are spread.

Defined results: texts that are null or empty, or whose token bytes are not
those of the text behind a space, have no tokens, and zeros; special tokens'
names inside a text are plain text; texts of any length are aligned whole; a
null doc_id is kept; rows of one id, and equal rows, are documents of their
own; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymart.llm.tokens import ID_TYPE, encoder
from daymart.operators.lookup import lookup_key
from daymart.operators.scratch import settle

KEPT_WORDS = 600_000
_CHARS_AT_ONCE = 1_000_000
_NEW_AT_ONCE = 20_000
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)
_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which tokens of A end a leaf group.

    ``ends_a`` and ``ends_b`` grow; ``first`` and ``last`` tokens of A are
    intervals that end alike on both sides. All open intervals go one step at
    a time: each looks, outwards from its middle, for a token of A whose end B
    has as well, and is split there; one that finds none is a leaf.
    """
    cut = np.zeros(len(ends_a), dtype=bool)
    cut[last] = True
    inside = last > first
    low, high = first[inside], last[inside]
    step = np.zeros(len(low), dtype=np.int64)
    while len(low):
        away = (step + 1) // 2
        k = (low + high - 1) // 2 + np.where(step % 2 == 1, away, -away)
        candidate = (k >= low) & (k < high)
        end = ends_a[np.where(candidate, k, low)]
        found = candidate & (ends_b[np.searchsorted(ends_b, end)] == end)
        cut[k[found]] = True
        open_ = ~found & (away <= (high - low) // 2 + 1)
        low = np.concatenate([low[found], k[found] + 1, low[open_]])
        high = np.concatenate([k[found], high[found], high[open_]])
        step = np.concatenate([np.zeros(2 * int(found.sum()), dtype=np.int64), step[open_] + 1])
        inside = high > low
        low, high, step = low[inside], high[inside], step[inside]
    return cut


class Aligner:
    """Both tokenizers, and what the words met so far are aligned to."""

    def __init__(self, name_a: str, name_b: str):
        self.words_a = encoder(name_a, True)
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name_a))
        self.tokenizer.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name_b))
        letters = {letter: byte for byte, letter in self.words_a.letters.items()}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.sizes_a = np.array([*map(len, self.bytes_a)], dtype=np.int64)
        self.sizes_b = np.array([*map(len, self.bytes_b)], dtype=np.int64)
        # A token as it is shown: inside and at the end of its side of a group.
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.table = [b"%d%s" % (i, mark) for ids, marks in ((a, (b",", b"|")), (b, (b",", b";"))) for mark in marks for i in ids]
        self.space_b = self.pieces.piece_to_id("▁")
        self.known: dict[str, int] = {}
        self.numbers: dict[int, int] = {}
        self._forget()

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        byte = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def _forget(self) -> None:
        self.known.clear()
        self.numbers.clear()
        self.shown: list[bytes] = []
        #: Of each word its tokens of A and B, groups and links, and the place of its first link.
        self.met = np.zeros((0, 5), dtype=np.int64)
        self.codes = np.zeros(0, dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int64)

    def align(self, a: list, b: list, data: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Groups as text; (tokens of A, of B, groups, links); and linked pairs, one after the other.

        For each stretch of ``data``, given the ids of its tokens; a stretch
        that its tokens do not spell has none.
        """
        flat_a, flat_b = [i for ids in a for i in ids], [i for ids in b for i in ids]
        spelled = b"".join(map(self.bytes_a.__getitem__, flat_a)), b"".join(map(self.bytes_b.__getitem__, flat_b))
        n_a, n_b = (np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) for ids in (a, b))
        ids_a, ids_b = np.array(flat_a, dtype=np.int64), np.array(flat_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        size = np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))
        until_a, until_b = np.cumsum(n_a), np.cumsum(n_b)
        joined = b"".join(data)
        whole = spelled == (joined, joined) and n_a.all() and n_b.all()
        if not (whole and np.array_equal(ends_a[until_a - 1], size) and np.array_equal(ends_b[until_b - 1], size)):
            return self._align_good(a, b, data)
        cut_a = shared_cuts(ends_a, ends_b, until_a - n_a, until_a - 1)
        cut_b = np.zeros(len(ends_b), dtype=bool)
        cut_b[np.searchsorted(ends_b, ends_a[cut_a])] = True
        # Leaves one after the other, each with its tokens of A, then those of B.
        leaf_a, leaf_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        order = np.argsort(np.concatenate([2 * leaf_a, 2 * leaf_b + 1]), kind="stable")
        second = 2 * len(self.bytes_a)
        shown_a = ids_a + np.where(cut_a, len(self.bytes_a), 0)
        shown_b = ids_b + np.where(cut_b, second + len(self.bytes_b), second)
        parts = [*map(self.table.__getitem__, np.concatenate([shown_a, shown_b])[order].tolist())]
        until = np.cumsum(n_a + n_b).tolist()
        shown = [b"".join(parts[x:y]) for x, y in zip([0, *until], until)]
        # Between two ends that follow each other, of whichever side, lies one link.
        ends = np.union1d(ends_a, ends_b)
        linked = ids_a[np.searchsorted(ends_a, ends)] << 32 | ids_b[np.searchsorted(ends_b, ends)]
        until_link = np.searchsorted(ends, size) + 1
        groups = np.cumsum(cut_a)[until_a - 1]
        counts = np.stack([n_a, n_b, np.diff(groups, prepend=0), np.diff(until_link, prepend=0)], axis=1)
        return shown, counts, linked

    def _align_good(self, a: list, b: list, data: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """``align`` where some stretches are not spelled by their tokens."""
        spelled = zip(data, a, b)
        good = [
            k
            for k, (text, x, y) in enumerate(spelled)
            if text and b"".join(map(self.bytes_a.__getitem__, x)) == text == b"".join(map(self.bytes_b.__getitem__, y))
        ]
        shown, counts = [b""] * len(data), np.zeros((len(data), 4), dtype=np.int64)
        linked = np.zeros(0, dtype=np.int64)
        if good:
            found, counts[good], linked = self.align([a[k] for k in good], [b[k] for k in good], [data[k] for k in good])
            for k, text in zip(good, found):
                shown[k] = text
        return shown, counts, linked

    def _encode_a(self, words: list[str]) -> list[list[int]]:
        found = iter(self.words_a._new_words([w for w in words if "<|" not in w], " "))
        return [
            self._alone(w if w[0] == "\n" else " " + w) if "<|" in w else np.frombuffer(next(found), dtype=ID_TYPE).tolist()
            for w in words
        ]

    def _alone(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, words: list[str]) -> None:
        """Align words, each with the space or line break before it."""
        for k in range(0, len(words), _NEW_AT_ONCE):
            part = words[k : k + _NEW_AT_ONCE]
            b = self.pieces.encode(part, num_threads=1)
            # The space that is put before a text is not there before a line break.
            b = [ids[1:] if w[0] == "\n" and ids[:1] == [self.space_b] else ids for w, ids in zip(part, b)]
            data = [(w if w[0] == "\n" else " " + w).encode() for w in part]
            shown, counts, linked = self.align(self._encode_a(part), b, data)
            self.known.update(zip(part, range(len(self.shown), len(self.shown) + len(part))))
            self.shown += shown
            places = len(self.links) + np.cumsum(counts[:, 3]) - counts[:, 3]
            self.met = np.concatenate([self.met, np.column_stack([counts, places])])
            codes, of = np.unique(linked, return_inverse=True)
            numbers = self.numbers
            new = [c for c in codes.tolist() if c not in numbers]
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
            self.codes = np.concatenate([self.codes, np.array(new, dtype=np.int64)])
            own = np.fromiter(map(numbers.__getitem__, codes.tolist()), dtype=np.int64, count=len(codes))
            self.links = np.concatenate([self.links, own[of]])

    def whole(self, text: str) -> tuple:
        """Counts, groups, pair codes and their times of a text that is not cut at spaces."""
        (shown,), counts, linked = self.align([self._alone(" " + text)], [self.pieces.encode(text)], [(" " + text).encode()])
        if not counts[0, 0]:
            return NOTHING
        codes, times = np.unique(linked, return_counts=True)
        return (*counts[0].tolist(), hashlib.sha256(shown[:-1]).hexdigest()), codes, times

    def texts(self, texts: list[str]) -> list[tuple]:
        """``whole`` of each text, for texts whose words stand behind single spaces or line breaks."""
        words = " ".join(texts).replace("\n", " \n").split(" ")
        sizes = np.array([t.count(" ") + t.count("\n") + 1 for t in texts], dtype=np.int64)
        flat = self._places(words)
        if (flat < 0).any():
            new = {w for w, place in zip(words, flat.tolist()) if place < 0}
            if len(self.known) + len(new) > KEPT_WORDS and self.known:
                self._forget()
                new = set(words)
            self._learn([*new])
            flat = self._places(words)
        until = np.cumsum(sizes)
        met = self.met[flat]
        sums = np.add.reduceat(met[:, :4], until - sizes, axis=0)
        bad = np.logical_or.reduceat(met[:, 0] == 0, until - sizes)
        n = met[:, 3]
        place = np.repeat(met[:, 4] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pairs = np.sort(np.repeat(np.repeat(np.arange(len(texts)), sizes) << 32, n) | self.links[place])
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, dtype=np.int64)
        times = np.diff(first, append=len(pairs))
        codes = self.codes[pairs[first] & 0xFFFFFFFF]
        cuts = np.searchsorted(pairs[first] >> 32, np.arange(len(texts) + 1))
        shown = [*map(self.shown.__getitem__, flat.tolist())]
        out = []
        for i, (a, b) in enumerate(zip((until - sizes).tolist(), until.tolist())):
            if bad[i]:
                out.append(NOTHING)
                continue
            groups = hashlib.sha256(b"".join(shown[a:b])[:-1]).hexdigest()
            part = slice(cuts[i], cuts[i + 1])
            out.append(((*sums[i].tolist(), groups), codes[part], times[part]))
        return out

    def _places(self, words: list[str]) -> np.ndarray:
        """Where each word is kept, -1 where it is not."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))


NOTHING = ((0, 0, 0, 0, ""), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


@lru_cache(maxsize=2)
def aligner(name_a: str, name_b: str) -> Aligner:
    """The aligner of this worker; it outlives a task, and so do the words it met."""
    return Aligner(name_a, name_b)


def _plainly_spaced(text: str) -> bool:
    """Whether all white space is single spaces and line breaks between other characters."""
    return len(text.split()) == text.count(" ") + text.count("\n") + 1


def align_texts(both: Aligner, texts: list[str | None]) -> list[tuple]:
    out: list = [None] * len(texts)
    plain = []
    for i, text in enumerate(texts):
        if not text:
            out[i] = NOTHING
        elif _plainly_spaced(text):
            plain.append(i)
        else:
            out[i] = both.whole(text)
    if plain:
        for i, found in zip(plain, both.texts([texts[i] for i in plain])):
            out[i] = found
    return out


def aligned_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """Counts and groups of each document, with its linked pairs (a << 32 | b) and their times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(tokenizer_a, tokenizer_b)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.asarray(pa.compute.fill_null(pa.compute.utf8_length(texts), 0)).cumsum()
            a = 0
            while a < len(ids):
                done = sizes[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(sizes, done + _CHARS_AT_ONCE)))
                yield _batch(ids.slice(a, b - a), align_texts(both, texts.slice(a, b - a).to_pylist()))
                a = b

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def _batch(ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    counts, codes, times = zip(*found)
    offsets = pa.array(np.cumsum([0, *map(len, codes)]), type=pa.int32())
    columns = [ids, *(pa.array([c[k] for c in counts], type=pa.int64()) for k in range(4))]
    columns.append(pa.array([c[4] for c in counts], type=pa.string()))
    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(codes), type=pa.int64())))
    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times).astype(np.int32), type=pa.int32())))
    return pa.RecordBatch.from_arrays(columns, names=[*_FIELDS, "pairs", "times"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count of documents that link it, and whether no pair of its A id has more; stored."""
    pairs = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    pairs = settle(pairs, "pair-counts")
    a = F.shiftright("pair", 32)
    # One row for each A id: as many as the vocabulary has.
    highest = pairs.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    marked = pairs.withColumn("a", a).join(F.broadcast(highest), "a")
    return settle(marked.select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "best-pairs")


def align_documents(docs: DataFrame, tokenizer_a: str = "byte_bpe_50k.json", tokenizer_b: str = "piece_bpe_32k.model") -> DataFrame:
    """Each document's alignment, with the corpus-wide counts of its links."""
    rows = aligned_documents(docs, tokenizer_a, tokenizer_b).withColumn("row", F.monotonically_increasing_id())
    aligned = settle(rows, "aligned")
    counts = pair_counts(aligned)
    each = aligned.select("row", *_FIELDS, F.explode_outer(F.arrays_zip("pairs", "times")).alias("link"))
    each = each.select("row", *_FIELDS, F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    # The rows of a document lie together, so they collapse before they move.
    found = lookup_key(each, counts.withColumn("documents", F.col("count")), ["pair"], ["count", "best"], count_column="documents")
    out = found.groupBy("row", *_FIELDS).agg(
        F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).cast("long").alias("n_best"),
        F.coalesce(F.sum(F.col("times") * F.col("count")), F.lit(0)).cast("long").alias("count_sum"),
    )
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
