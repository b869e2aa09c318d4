"""License scans by a positional index of rare licence words.

Templates are licence notices and whole short licences. Every word of a template
gets its inverse document frequency over all documents; the index holds each
word's postings, its places in the templates.

In a text, only its own rarest licence words are looked up, rarest first. A match
must cover ``MIN_COVERAGE`` of a template's weight, so what the text's words
leave to spare is a budget, and words that weigh more than twice the budget are
enough: the postings of a match meet at one beginning with at least their weight
less the budget. Templates whose words the text lacks are not looked up at all.

Postings are intersected by relative position: occurrence minus place in the
template is where the template would begin. Beginnings that differ by up to
``SHIFT`` are taken together, as words may be left out or put in. A beginning on
which enough weight meets is verified: a template's word is covered when it
stands within ``SHIFT`` of its place, and the key phrase must stand there too,
word for word. Nothing that covers enough is missed by the intersection.

The fixed phrases of a scan are templates that must match whole, without any
shift; they are found through the same index.

Defined results: a null or empty text has no words, no places and score 0;
texts of any length are scanned whole; repeated rows are scanned each; an
empty table gives no rows. The score is the largest coverage among the notices
found, 1 where a fixed phrase stands. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.tokens import small_batches

#: Phrases and the label each one stands for.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices of public licences: label, key phrase, text.
NOTICES = [
    ("mit-notice", "mit license", "released under the mit license"),
    (
        "mit-text",
        "without restriction",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    ("apache-2.0", "apache license", "licensed under the apache license version 2 0"),
    (
        "apache-2.0-header",
        "apache license",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ),
    ("gpl-3.0", "general public license", "licensed under the gnu general public license version 3"),
    (
        "gpl-header",
        "general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    ("lgpl", "lesser general public license", "gnu lesser general public license"),
    (
        "bsd",
        "redistributions of source code must retain",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice",
    ),
    ("mpl-2.0", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "cc by 4", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "cc by sa", "licensed under cc by sa 4 0"),
    ("unlicense", "public domain", "free and unencumbered software released into the public domain"),
]

#: Whole licences: label, key phrase, text.
WHOLE_LICENCES = [
    (
        "mit-whole",
        "without restriction",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software the "
        "software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
        "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
        "in the software",
    ),
    (
        "isc-whole",
        "with or without fee",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software "
        "is provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
        "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    (
        "bsd-2-clause-whole",
        "redistributions in binary form must reproduce",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met 1 redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution this software is provided by the copyright holders and contributors "
        "as is and any express or implied warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or "
        "contributors be liable for any direct indirect incidental special exemplary or consequential damages including "
        "but not limited to procurement of substitute goods or services loss of use data or profits or business "
        "interruption however caused and on any theory of liability whether in contract strict liability or tort "
        "including negligence or otherwise arising in any way out of the use of this software even if advised of the "
        "possibility of such damage",
    ),
    (
        "zlib-whole",
        "must not be misrepresented",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely subject "
        "to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that "
        "you wrote the original software if you use this software in a product an acknowledgment in the product "
        "documentation would be appreciated but is not required 2 altered source versions must be plainly marked as "
        "such and must not be misrepresented as being the original software 3 this notice may not be removed or altered "
        "from any source distribution",
    ),
    (
        "boost-whole",
        "solely in the form of machine executable object code",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license the software to use reproduce display distribute execute "
        "and transmit the software and to prepare derivative works of the software and to permit third parties to whom "
        "the software is furnished to do so all subject to the following the copyright notices in the software and this "
        "entire statement including the above license grant this restriction and the following disclaimer must be "
        "included in all copies of the software in whole or in part and all derivative works of the software unless "
        "such copies or derivative works are solely in the form of machine executable object code generated by a source "
        "language processor",
    ),
]
MIN_COVERAGE = 0.75
#: Places that a word may stand before or after its own: words left out or put in.
SHIFT = 3
#: Sums of weights in different orders differ by less.
_ROUNDING = 1e-9

# A-Z to lower case; ASCII that is no digit or letter to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: tuple[bytes, ...]
    whole: bool


def _template(label: str, text: str, key: str, whole: bool) -> Template:
    return Template(label, tuple(words_of(text)), tuple(words_of(key)), whole)


def templates() -> list[Template]:
    fixed = [_template(label, phrase, phrase, True) for phrase, label in PHRASES.items()]
    return fixed + [_template(label, text, key, False) for label, key, text in NOTICES + WHOLE_LICENCES]


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word stands, and the documents.

    Each task sums its own; what comes to the driver is one row a word.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = defaultdict(int)
        for frame in frames:
            seen[""] += len(frame)
            for text in frame["text"]:
                for word in vocabulary.intersection(words_of(text)):
                    seen[word.decode()] += 1
        if seen:
            yield pd.DataFrame({"word": pd.Series(list(seen), dtype=object), "n": list(seen.values())})

    rows = docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"].encode(): r["n"] for r in rows.collect()}
    return found, found.pop(b"", 0)


class LicenseIndex:
    def __init__(self, frequencies: dict[bytes, int], documents: int):
        self.templates = templates()
        words = {w for t in self.templates for w in t.words}
        self.idf = {w: math.log((documents + 1) / (frequencies.get(w, 0) + 1)) + 0.01 for w in words}
        self.weight = [sum(self.idf[w] for w in t.words) for t in self.templates]
        #: What a match must weigh at least.
        self.need = [w if t.whole else MIN_COVERAGE * w for t, w in zip(self.templates, self.weight)]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(self.templates):
            for q, word in enumerate(template.words):
                self.postings[word].append((t, q))
        #: Templates of a word, with its weight in all its places there.
        self.shares = {w: sorted(Counter(t for t, _ in at).items()) for w, at in self.postings.items()}
        self.shares = {w: [(t, n * self.idf[w]) for t, n in at] for w, at in self.shares.items()}
        self.vocabulary = frozenset(self.postings)
        #: Rarest first; ties by the word.
        self.rank = {w: k for k, w in enumerate(sorted(words, key=lambda w: (-self.idf[w], w)))}

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = words_of(text)
        lookups, least = self._lookups(self.vocabulary.intersection(words))
        if not lookups:
            return len(words), 0, None, None, "", "", 0.0
        met: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for p, word in enumerate(words):
            if word in lookups:
                for t, q in lookups[word]:
                    met[t][p - q].append(q)
        base, base_labels, labels, score = [], set(), set(), 0.0
        for t, beginnings in met.items():
            template = self.templates[t]
            for start in self._starts(t, beginnings, least[t]):
                if template.whole:
                    if start >= 0 and tuple(words[start : start + len(template.words)]) == template.words:
                        base.append(start)
                        base_labels.add(template.label)
                        score = 1.0
                    continue
                coverage = self._coverage(words, t, start)
                if coverage >= MIN_COVERAGE and self._has_key(words, template, start):
                    labels.add(template.label)
                    score = max(score, coverage)
        first, last = (min(base), max(base)) if base else (None, None)
        joined = ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels))
        return len(words), len(base), first, last, *joined, score

    def _lookups(self, own: frozenset[bytes]) -> tuple[dict[bytes, list[tuple[int, int]]], dict[int, float]]:
        """Postings of the text's rarest licence words, and the least weight that must meet by template."""
        present: dict[int, float] = defaultdict(float)
        for word in own:
            for t, weight in self.shares[word]:
                present[t] += weight
        spare = {t: w - self.need[t] + _ROUNDING for t, w in present.items() if w + _ROUNDING >= self.need[t]}
        if not spare:
            return {}, {}
        taken = dict.fromkeys(spare, 0.0)
        lookups: dict[bytes, list[tuple[int, int]]] = {}
        for word in sorted(own, key=self.rank.__getitem__):
            open_ = {t: w for t, w in self.shares[word] if t in spare and taken[t] <= 2 * spare[t]}
            if open_:
                lookups[word] = [(t, q) for t, q in self.postings[word] if t in open_]
                for t, weight in open_.items():
                    taken[t] += weight
        return lookups, {t: taken[t] - spare[t] for t in spare}

    def _starts(self, t: int, beginnings: dict[int, list[int]], least: float) -> Iterator[int]:
        """Beginnings on which at least ``least`` of the looked up weight meets, shifts allowed for."""
        template, reach = self.templates[t], 0 if self.templates[t].whole else SHIFT
        weights = [self.idf[w] for w in template.words]
        sums = {d: sum(weights[q] for q in at) for d, at in beginnings.items()}
        for start in sorted({d + k for d in beginnings for k in range(-reach, reach + 1)}):
            near = range(start - reach, start + reach + 1)
            # A word that stands twice nearby counts once.
            if sum(sums.get(d, 0.0) for d in near) >= least - _ROUNDING:
                places = {q for d in near for q in beginnings.get(d, ())}
                if sum(weights[q] for q in places) >= least - _ROUNDING:
                    yield start

    def _coverage(self, words: list[bytes], t: int, start: int) -> float:
        """Share of the template's weight whose words stand near their places."""
        matched = 0.0
        for p, word in enumerate(self.templates[t].words, start):
            if word in words[max(0, p - SHIFT) : max(0, p + SHIFT + 1)]:
                matched += self.idf[word]
        return min(1.0, matched / self.weight[t])

    def _has_key(self, words: list[bytes], template: Template, start: int) -> bool:
        near = words[max(0, start - SHIFT) : max(0, start + len(template.words) + SHIFT)]
        n = len(template.key)
        return any(tuple(near[i : i + n]) == template.key for i in range(len(near) - n + 1))


SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Licence places, labels and score of each document."""
    docs = docs.select("doc_id", "text")
    vocabulary = {w for t in templates() for w in t.words}
    frequencies, documents = document_frequencies(docs, vocabulary)
    index = docs.sparkSession.sparkContext.broadcast(LicenseIndex(frequencies, documents))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for frame in small_batches(frames, "text"):
            rows = [index.value.scan(text) for text in frame["text"]]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy(dtype=object))
            for name in ("doc_id", "first_word", "last_word"):
                out[name] = out[name].astype("Int64")
            yield out

    return docs.mapInPandas(scan, SCAN)
