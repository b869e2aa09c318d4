"""Token ids of whole texts, with the pieces of a block encoded once each.

Public vocabularies split a text into pieces before they merge anything, so a
text's ids are its pieces' ids one after the other. Texts are cut where every
such vocabulary cuts: at spaces and line breaks, and between letters, marks and
digits. Characters of which that is not sure are not cut off from what stands
beside them. A worker keeps the ids of pieces it has met; the tokenizer itself
sees each distinct piece of a block once. The store is only a saving: it is
emptied when it grows past ``KEPT_WORDS``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

KEPT_WORDS = 600_000
ID_TYPE = "<u4"
#: Characters of text handled at once, so long texts do not meet in one list.
_BLOCK_CHARS = 1_000_000
#: The same for texts that are encoded: the more at once, the fewer pieces are looked up.
_ENCODED_CHARS = 2_000_000
_WORDS_AT_ONCE = 1000
#: Pieces of one call's text; longer texts are merged more slowly.
_PIECES_AT_ONCE = 100
_LONG_WORD = 200
_TWO_SPACES = re.compile(r"\s\s")
#: Bytes of white space other than spaces and line breaks, or the first of several such bytes.
_OTHER_SPACES = b"\t\v\f\r\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3"
_LINES_AS_SPACES = bytes.maketrans(b"\n", b" ")
#: First bytes of the letters from U+0240 on.
_BEYOND_LATIN = bytes(range(0xC9, 256))
_ODD, _LETTER, _MARK, _DIGIT, _LINE, _SPACE = range(6)
#: Marks that no vocabulary joins to letters; an apostrophe may begin a piece such as 's.
_MARKS = b'-.,;:!?#*$%&|<>()[]{}/+=_@~^"'
#: The first of the two bytes of a letter of Latin-1.
_LATIN = 0xC3


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


def _byte_classes(capitals: bool) -> tuple[np.ndarray, np.ndarray]:
    """Classes of bytes, and of the second bytes of Latin-1's letters."""
    classes, latin = np.zeros(256, dtype=np.uint8), np.zeros(256, dtype=np.uint8)
    for kind, members in ((_MARK, _MARKS), (_DIGIT, b"0123456789"), (_LINE, b"\n"), (_SPACE, b" ")):
        classes[list(members)] = kind
    classes[ord("a") : ord("z") + 1] = _LETTER
    latin[0x9F:0xC0] = _LETTER
    if capitals:
        classes[ord("A") : ord("Z") + 1] = _LETTER
        latin[0x80:0x9F] = _LETTER
    # The signs of multiplication and division lie among the letters.
    latin[[0x97, 0xB7]] = _ODD
    return classes, latin


def _cut_between(single_digits: bool) -> np.ndarray:
    """Whether a piece begins between two classes; indexed by 6 times the first, plus the second."""
    cut = np.zeros((6, 6), dtype=bool)
    runs = [_LETTER, _MARK, _DIGIT]
    cut[np.ix_(runs, runs)] = ~np.eye(3, dtype=bool)
    cut[_DIGIT, _DIGIT] = single_digits
    cut[_LINE, :] = cut[:, _LINE] = cut[:, _SPACE] = True
    return cut.ravel()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``spaced`` says that a piece's ids depend on the space before it (byte-level
    vocabularies); otherwise white space is dropped by the vocabulary, letters
    are lower-cased and digits stand alone.
    """

    def __init__(self, name: str, spaced: bool):
        path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        # A special token of the vocabulary is cut out before anything else
        # happens to a text, so it can stand between words in one call.
        mark = "<|endoftext|>"
        self.mark = mark, self.tokenizer.token_to_id(mark)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.classes, self.latin = _byte_classes(capitals=spaced)
        self.cut_between = _cut_between(single_digits=not spaced)
        with open(path, encoding="utf-8") as file:
            self._make_lean(json.load(file))
        self._forget(np.zeros(0, dtype=np.int64))

    def _make_lean(self, full: dict) -> None:
        """The same model for texts of many pieces, each of which shows where it ends.

        Either the vocabulary marks a piece's last letter, which is written as
        a letter of its own here, or a letter that is never merged stands behind each piece.
        """
        model = full["model"]
        suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.last = {x: chr(0xE000 + b) for b, x in self.letters.items()} if suffix else {}

        def rewritten(token: str) -> str:
            body = token.removesuffix(suffix) if suffix else token
            return body if body == token or not body else body[:-1] + self.last[body[-1]]

        vocabulary = {rewritten(t): i for t, i in model["vocab"].items()}
        lean = {**model, "vocab": vocabulary, "merges": [(rewritten(a), rewritten(b)) for a, b in merges]}
        lean["end_of_word_suffix"] = None
        parts = {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None, "added_tokens": []}
        self.lean = Tokenizer.from_str(json.dumps(full | parts | {"model": lean}))
        merged = {b[0] for _, b in merges} | {a[-1] for a, _ in merges}
        self.stop = "" if suffix else next(x for b, x in self.letters.items() if b < 9 and x not in merged)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends = [i for t, i in model["vocab"].items() if t.endswith(suffix)] if suffix else vocabulary[self.stop]
        self.is_end[ends] = True

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Many go in one call, with a special token between them."""
        mark, mark_id = self.mark
        odd = {i for i, w in enumerate(words) if "<|" in w or len(w) > _LONG_WORD}
        plain = [w for i, w in enumerate(words) if i not in odd] if odd else words
        out: list[bytes] = []
        for a in range(0, len(plain), _WORDS_AT_ONCE):
            joined = mark.join(plain[a : a + _WORDS_AT_ONCE]) + mark
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=ID_TYPE)
            out += _between(ids, mark_id)
        if odd:
            alone = {i: self._alone(words[i]) for i in odd}
            rest = iter(out)
            out = [alone[i] if i in odd else next(rest) for i in range(len(words))]
        return out

    def _alone(self, text: str) -> bytes:
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype=ID_TYPE).tobytes()

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the vocabulary does not split, one after the other, and how many each has."""
        space, line = self.letters[32], self.letters[10]
        if not self.spaced:
            pieces = [p[1:] if p[0] == " " else p for p in pieces]
        # Bytes of ASCII other than white space stand for themselves.
        written = [p if p.isascii() else self._in_letters(p.replace(" ", space), space) for p in pieces]
        if self.last:
            written = [p[:-1] + self.last[p[-1]] for p in written]
        found = [np.zeros(0, dtype=ID_TYPE)]
        for a in range(0, len(written), _PIECES_AT_ONCE):
            joined = self.stop.join(written[a : a + _PIECES_AT_ONCE]) + self.stop
            joined = joined.replace(" ", space).replace("\n", line)
            found.append(np.array(self.lean.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=ID_TYPE))
        ids = np.concatenate(found)
        ends = self.is_end[ids]
        counts = np.diff(np.flatnonzero(ends), prepend=-1)
        return (ids[~ends], counts - 1) if self.stop else (ids, counts)

    def _in_letters(self, piece: str, space: str) -> str:
        body = piece[1:] if space and piece[0] == space else piece
        return piece[: len(piece) - len(body)] + body.encode().decode("latin-1").translate(self.letters)

    def _ids_of(self, pieces: list[bytes], odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, those that the vocabulary may split last; how many each has; and their order."""
        odd = odd | (np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) > _LONG_WORD)
        order = np.argsort(odd, kind="stable")
        texts = [pieces[i].decode() for i in order.tolist()]
        whole = len(texts) - int(odd.sum())
        ids, counts = self._encode_pieces(texts[:whole])
        others = self._encode(texts[whole:])
        ids = np.concatenate([ids, np.frombuffer(b"".join(others), dtype=ID_TYPE)])
        sizes = np.fromiter(map(len, others), dtype=np.int64, count=len(others)) // ids.itemsize
        return ids, np.concatenate([counts, sizes]), order

    def _pieces(self, data: bytes, texts: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
        """Where the pieces of ``data`` begin, which they are, and which distinct ones are not one piece for sure.

        ``texts`` are the places where texts begin.
        """
        codes = np.frombuffer(data, dtype=np.uint8)
        classes = self.classes[codes]
        lead = np.flatnonzero(codes == _LATIN)
        classes[lead] = classes[lead + 1] = self.latin[codes[lead + 1]]
        cut = np.ones(len(codes), dtype=bool)
        cut[1:] = self.cut_between[6 * classes[:-1] + classes[1:]]
        cut[texts[texts < len(codes)]] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(codes)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        found = found.dictionary_encode()
        which = np.asarray(found.indices)
        odd = np.zeros(len(found.dictionary), dtype=bool)
        unsure = np.flatnonzero(classes == _ODD)
        odd[which[np.searchsorted(starts, unsure, side="right") - 1]] = True
        # A space is a piece only where white space or the text's end follows.
        alone = np.flatnonzero((classes[starts] == _SPACE) & (np.diff(offsets) == 1))
        odd[which[alone]] = True
        if not self.spaced:
            odd[which[classes[starts] == _LINE]] = True
        return starts, found, odd

    def _forget(self, kept: np.ndarray) -> None:
        """Keep only the pieces at these places of the store."""
        if not len(kept):
            self.known: dict[bytes, int] = {}
            self.ids = np.zeros(0, dtype=ID_TYPE)
            self.begins = self.counts = np.zeros(0, dtype=np.int64)
            self.met_again = np.zeros(0, dtype=bool)
            return
        names = list(self.known)
        self.known = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.ids = self.ids[_spread(self.begins[kept], self.counts[kept])]
        self.counts = self.counts[kept]
        self.begins = np.cumsum(self.counts) - self.counts
        self.met_again = np.zeros(len(kept), dtype=bool)

    def _places(self, pieces: list[bytes], odd: np.ndarray) -> np.ndarray:
        """Where the store holds these distinct pieces; new ones are encoded."""
        places = self._known_places(pieces)
        met = places[places >= 0]
        fresh = len(pieces) - len(met)
        if len(self.known) + fresh > KEPT_WORDS:
            # Pieces that came back are worth keeping; most never do.
            keep = self.met_again.copy() if self.met_again.sum() < KEPT_WORDS // 2 else np.zeros(len(self.known), dtype=bool)
            keep[met] = True
            self._forget(np.flatnonzero(keep))
            places = self._known_places(pieces)
        else:
            self.met_again[met] = True
        if fresh:
            at = np.flatnonzero(places < 0)
            ids, counts, order = self._ids_of([pieces[i] for i in at.tolist()], odd[at])
            at = at[order]
            places[at] = np.arange(len(self.known), len(self.known) + fresh)
            self.known.update(zip([pieces[i] for i in at.tolist()], places[at].tolist()))
            self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
            self.met_again = np.concatenate([self.met_again, np.zeros(fresh, dtype=bool)])
        return places

    def _known_places(self, pieces: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))

    def _encode_cut(self, texts: list[bytes], keep: bool = True) -> list[bytes]:
        """Ids of texts that may be cut into pieces; ``keep`` puts these into the store."""
        until = np.cumsum([0, *map(len, texts)])
        starts, found, odd = self._pieces(b"".join(texts), until[:-1])
        pieces, which = found.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(found.indices)
        if keep:
            places = self._places(pieces, odd)
            all_ids, begins, counts = self.ids, self.begins[places], self.counts[places]
        else:
            all_ids, sizes, order = self._ids_of(pieces, odd)
            begins, counts = np.empty_like(sizes), np.empty_like(sizes)
            begins[order], counts[order] = np.cumsum(sizes) - sizes, sizes
        counts = counts[which]
        ids = all_ids[_spread(begins[which], counts)].tobytes()
        ends = np.append(0, np.cumsum(counts))[np.searchsorted(starts, until)] * all_ids.itemsize
        return [ids[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def _new_words(self, words: list[str], prefix: str) -> list[bytes]:
        """Ids of words as they stand in a text, after ``prefix``; nothing is kept."""
        return self._encode_cut([(prefix + w if w[:1] != "\n" else w).encode() for w in words], keep=False)

    def _cuttable(self, text: str) -> bytes | None:
        """A text's bytes to be cut into pieces; none if it is encoded whole.

        Special tokens lie across pieces, and a spaced vocabulary splits runs
        of white space by their length.
        """
        if "<|" in text and any(token in text for token in self.special):
            return None
        data = text.encode()
        if self.spaced:
            spaces = data.translate(_LINES_AS_SPACES, _OTHER_SPACES)
            if b"  " in spaces or len(spaces) < len(data) and _TWO_SPACES.search(text):
                return None
        elif len(data.translate(None, _BEYOND_LATIN)) == len(data):
            # Letters are lower-cased by the vocabulary; done first, pieces are fewer.
            # Letters of other scripts may be lower-cased by their place.
            return text.lower().encode()
        return data

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [*map(self._cuttable, texts)]
        ids = iter(self._encode_cut([data for data in cut if data is not None]))
        return [self._alone(text) if data is None else next(ids) for text, data in zip(texts, cut)]


def _spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of stretches, one stretch after the other."""
    ends = np.cumsum(counts)
    return np.repeat(begins - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def _between(ids: np.ndarray, stop_id: int) -> list[bytes]:
    """The ids before each ``stop_id``."""
    data, width = ids.tobytes(), ids.itemsize
    stops = (np.flatnonzero(ids == stop_id) * width).tolist()
    return [data[a:b] for a, b in zip([0, *(x + width for x in stops)], stops)]


@lru_cache(maxsize=4)
def encoder(name: str, spaced: bool) -> Encoder:
    """The encoder of this worker; it outlives a task, and so do the words it met."""
    return Encoder(name, spaced)


def encode_texts(encoder: Encoder, texts: list[str | None]) -> Iterator[bytes]:
    """Ids of each text in order; null is the empty text."""
    block: list[str] = []
    chars = 0
    for text in texts:
        block.append(text or "")
        chars += len(block[-1])
        if chars >= _ENCODED_CHARS:
            yield from encoder.encode(block)
            block, chars = [], 0
    yield from encoder.encode(block)


def small_batches(frames: Iterator[pd.DataFrame], column: str, chars: int = _BLOCK_CHARS) -> Iterator[pd.DataFrame]:
    """Cut frames so that the texts of one hold about ``chars`` characters."""
    for frame in frames:
        sizes = frame[column].str.len().fillna(0).to_numpy(dtype=float).cumsum() if len(frame) else np.zeros(0)
        cuts = (sizes // chars).astype(int) if len(frame) else np.zeros(0, dtype=int)
        starts = [0, *(np.flatnonzero(np.diff(cuts)) + 1), len(frame)]
        for a, b in zip(starts, starts[1:]):
            if b > a:
                yield frame.iloc[a:b]

