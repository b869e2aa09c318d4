"""Toxic spans by a linear-chain conditional random field.

Words are tagged O or T. A word's features are itself and its beginnings; the
features kept are those that labelled documents tie to toxicity. Labels are of
documents, so words get theirs from them: in a toxic document the words with a
strongly tied feature are T, all others are O. The field is trained on the
stretches around words that have features, forward and backward over all of
them at once.

Scoring runs forward and backward over a whole text. Words without features
all have the same potentials, so a run of them is one power of a two by two
matrix and long texts cost what their featured words cost. The marginals give
offending spans, their sum and maximum the document's score, put on the scale
of probabilities by a small logistic fit on the training documents.

The model is fitted on at most ``MAX_LABELLED`` labelled documents, the first
by a hash of their id, and on all features that these tie to toxicity. Tasks cut
the stretches and sum equal ones, so the driver trains on distinct stretches
with their counts, however long the documents are.

Defined results: null and empty texts get the score of a text without any
featured word; texts of any length are scored whole; repeated rows are scored
each; no labels, or one class only, give every text the share of toxic labels
(0 without any); an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.llm.tokens import small_batches
from daymart.operators.scratch import settle

MAX_LABELLED = 24_000
MIN_TOXIC_DOCS = 4
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
SPAN_MARGINAL = 0.5
#: A feature is kept, and its words are T, from these shares of toxic documents.
KEPT_SHARE, STRONG_SHARE = 0.35, 0.6
#: Words beside a stretch, and words that a stretch's featured ones may span.
_CONTEXT, _SPAN = 4, 16
_STEPS, _RATE, _L2 = 120, 0.15, 1e-3
_KNOWN_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def lowered(text: str | None) -> str:
    """The text in lower case, each character in its place.

    One letter alone lowers to two characters; it is taken as a plain i.
    """
    return (text or "").replace("\u0130", "i").lower()


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


def _wilson(hits: Column, n: Column) -> Column:
    """Lower end of the 95 % interval of a share."""
    z2 = 1.96**2
    p = hits / n
    return (p + z2 / (2 * n) - 1.96 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


class _Known(dict):
    """Feature numbers of a word, worked out once."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        found = tuple(self.numbers[f] for f in features_of(word) if f in self.numbers)
        self[word] = found
        return found


@dataclass
class Field:
    """Weights: a score for T by feature and for any word, and transitions."""

    numbers: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -8.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: tuple[float, ...] = (-30.0, 0.0, 0.0, 0.0)

    def emission(self, found: tuple[int, ...]) -> float:
        return self.bias + sum(self.weights[f] for f in found)


class Tagger:
    """A field made ready for whole texts."""

    def __init__(self, model: Field):
        self.model = model
        self.known = _Known(model.numbers)
        base = np.exp(model.moves - model.moves.max())
        self.move = base
        #: Powers of two of the step over a word without features.
        step = base * np.array([1.0, math.exp(model.bias)])
        self.powers = [step / step.max()]
        for _ in range(40):
            square = self.powers[-1] @ self.powers[-1]
            self.powers.append(square / square.max())
        self.runs: dict[int, np.ndarray] = {}

    def run(self, n: int) -> np.ndarray:
        """The step over ``n`` words without features, up to its scale."""
        if n not in self.runs:
            if len(self.runs) > 5_000:
                self.runs.clear()
            out = np.eye(2)
            for k, power in enumerate(self.powers):
                if n >> k & 1:
                    out = out @ power
                    out = out / out.max()
            self.runs[n] = out
        return self.runs[n]

    def marginals(self, n: int, places: list[int], found: list[tuple[int, ...]]) -> list[float]:
        """P(T) of the featured words at ``places`` of a text of ``n`` words."""
        m = len(places)
        ahead = np.array([1.0, 0.0])
        forward, steps, last = [], [], -1
        for place, numbers in zip(places, found):
            score = min(self.model.emission(numbers), 60.0)
            step = self.run(place - last - 1) @ (self.move * np.array([1.0, math.exp(score)]))
            step = step / step.max()
            ahead = ahead @ step
            ahead = ahead / ahead.sum()
            forward.append(ahead)
            steps.append(step)
            last = place
        behind = self.run(n - 1 - last) @ np.ones(2)
        out = [0.0] * m
        for k in range(m - 1, -1, -1):
            both = forward[k] * behind
            out[k] = float(both[1] / both.sum())
            behind = steps[k] @ behind
            behind = behind / behind.max()
        return out

    def tag(self, text: str | None) -> tuple[int, list[int], list[tuple[int, ...]], list[float]]:
        """Words, and places, features and marginals of those with features."""
        words = _WORD.findall(lowered(text))
        found = list(map(self.known.__getitem__, words))
        if not any(found):
            return len(words), [], [], []
        places = [i for i, f in enumerate(found) if f]
        numbers = [found[i] for i in places]
        return len(words), places, numbers, self.marginals(len(words), places, numbers)

    def spans(self, text: str, places: list[int], marginals: list[float]) -> list[tuple[int, int, float]]:
        """(start, end, marginal) in characters of stretches tagged T.

        Offsets are those of the text itself.
        """
        hot = {p: m for p, m in zip(places, marginals) if m >= SPAN_MARGINAL}
        out: list[tuple[int, int, float]] = []
        last = None
        for k, match in enumerate(_WORD.finditer(lowered(text))) if hot else ():
            if k in hot:
                if last == k - 1:
                    start, _, best = out.pop()
                    out.append((start, match.end(), max(best, hot[k])))
                else:
                    out.append((match.start(), match.end(), hot[k]))
                last = k
        return out

    def score(self, marginals: list[float]) -> float:
        at = float(np.dot(self.model.scale, _summary(marginals)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, at))))


def _summary(marginals: list[float]) -> np.ndarray:
    """What a document's score is made of: its largest marginal and their sum."""
    if not marginals:
        return np.array([1.0, 0.0, 0.0, 0.0])
    most = max(marginals)
    return np.array([1.0, most, math.log1p(sum(marginals)), 1.0 if most >= 0.5 else 0.0])


def _forward_backward(scores: np.ndarray, mask: np.ndarray, moves: np.ndarray, counts: np.ndarray):
    """Log likelihood parts, marginals and pair sums of stretches (B, L) that occur ``counts`` times."""
    b, n = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    alpha = np.zeros((n, b, 2))
    alpha[0] = emit[:, 0] + moves[0]
    for t in range(1, n):
        step = np.logaddexp(alpha[t - 1][:, :1] + moves[0], alpha[t - 1][:, 1:] + moves[1]) + emit[:, t]
        alpha[t] = np.where(mask[:, t, None], step, alpha[t - 1])
    log_z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
    beta = np.zeros((n, b, 2))
    for t in range(n - 2, -1, -1):
        ahead = beta[t + 1] + emit[:, t + 1]
        step = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
        beta[t] = np.where(mask[:, t + 1, None], step, beta[t + 1])
    marginal = np.exp(alpha[..., 1] + beta[..., 1] - log_z).T * mask
    pairs = np.zeros((2, 2))
    for t in range(1, n):
        live = mask[:, t]
        at = alpha[t - 1][:, :, None] + moves + (emit[:, t] + beta[t])[:, None, :] - log_z[:, None, None]
        pairs += (np.exp(at[live]) * counts[live, None, None]).sum(axis=0)
    # A stretch begins after an O.
    first = (np.exp(alpha[0] + beta[0] - log_z[:, None]) * counts[:, None]).sum(axis=0)
    pairs[0] += first
    return log_z, marginal, pairs


def train(stretches: list[tuple[list[tuple[int, ...]], list[int], int]], numbers: dict[str, int]) -> Field:
    """Fit the field to (features, tags, count) of distinct stretches by gradient steps."""
    longest = max(len(t) for _, t, _ in stretches)
    b = len(stretches)
    counts = np.array([n for _, _, n in stretches], dtype=float)
    tags, mask = np.zeros((b, longest), dtype=int), np.zeros((b, longest), dtype=bool)
    row, col = [], []
    for k, (found, own, _) in enumerate(stretches):
        tags[k, : len(own)], mask[k, : len(own)] = own, True
        for t, fs in enumerate(found):
            row += [k * longest + t] * len(fs)
            col += fs
    row, col = np.array(row, dtype=int), np.array(col, dtype=int)
    before = np.concatenate([np.zeros((b, 1), dtype=int), tags[:, :-1]], axis=1)
    seen = np.zeros((2, 2))
    each = np.broadcast_to(counts[:, None], mask.shape)
    np.add.at(seen, (before[mask], tags[mask]), each[mask])
    size = len(numbers)
    theta = np.zeros(size + 5)
    theta[size] = -3.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, _STEPS + 1):
        moves = theta[size + 1 :].reshape(2, 2)
        scores = (np.bincount(row, theta[col], minlength=b * longest)).reshape(b, longest) + theta[size]
        _, marginal, pairs = _forward_backward(scores, mask, moves, counts)
        off = ((marginal - tags * mask) * counts[:, None]).ravel()
        slope = np.concatenate([np.bincount(col, off[row], minlength=size), [off.sum()], (pairs - seen).ravel()])
        slope = slope / counts.sum() + _L2 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta - _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(dict(numbers), theta[:size], float(theta[size]), theta[size + 1 :].reshape(2, 2))


def _fit_scale(parts: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, lightly held to zero."""
    w = np.zeros(parts.shape[1])
    hold = np.diag([1e-6, 1e-2, 1e-2, 1e-2])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(parts @ w, -30, 30)))
        slope = parts.T @ (weight * (p - toxic)) + hold @ w
        curve = (parts * (weight * p * (1 - p))[:, None]).T @ parts + hold + 1e-9 * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w = w - np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(x) for x in w)


def labelled_sample(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` ids to learn from, the first by hash, with their label."""
    rows = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    ids = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("is_toxic"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _feature_counts(rows: DataFrame) -> DataFrame:
    """Documents and toxic documents of each feature; tasks sum their own first."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, every = Counter(), Counter()

        def summed() -> pd.DataFrame:
            names = pd.Series(list(every), dtype=object)
            return pd.DataFrame({"f": names, "toxic": [toxic[f] for f in every], "n": list(every.values())})

        for frame in frames:
            for text, label in zip(frame["text"], frame["is_toxic"]):
                own = {f for w in set(_WORD.findall(lowered(text))) for f in features_of(w)}
                every.update(own)
                if label:
                    toxic.update(own)
                if len(every) > 200_000:
                    yield summed()
                    toxic, every = Counter(), Counter()
        if every:
            yield summed()

    counted = rows.select("text", "is_toxic").mapInPandas(count, "f string, toxic long, n long")
    return counted.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def _choose(rows: DataFrame) -> tuple[dict[str, int], set[int]]:
    """Numbers of the features kept, and those that make a word T."""
    enough = F.col("toxic") >= F.greatest(F.lit(MIN_TOXIC_DOCS), F.col("n") * KEPT_SHARE)
    share = _wilson(F.col("toxic"), F.col("n"))
    kept = _feature_counts(rows).filter(enough).withColumn("share", share).filter(F.col("share") >= KEPT_SHARE)
    tied = sorted(((r["share"], r["f"]) for r in kept.collect()), key=lambda x: (-x[0], x[1]))
    numbers = {f: k for k, (_, f) in enumerate(tied)}
    return numbers, {k for k, (s, _) in enumerate(tied) if s >= STRONG_SHARE}


def _compact(rows: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """The sampled documents as their featured words; stored."""
    spread = rows.sparkSession.sparkContext.broadcast(numbers)

    def reduce_(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Known(spread.value)
        for frame in frames:
            out = []
            for text, label in zip(frame["text"], frame["is_toxic"]):
                words = _WORD.findall(lowered(text))
                found = list(map(known.__getitem__, words))
                places = [i for i, f in enumerate(found) if f]
                out.append((len(words), places, [list(found[i]) for i in places], int(label)))
            yield pd.DataFrame(out, columns=["n", "places", "found", "toxic"])

    schema = "n long, places array<int>, found array<array<int>>, toxic int"
    return settle(rows.select("text", "is_toxic").mapInPandas(reduce_, schema), "featured")


def _stretches(places: list[int], found: list, n: int, tags: list[int]) -> Iterator[tuple[list, list[int]]]:
    """Stretches of a text around its featured words, with some words beside them.

    A word beside a stretch that is featured itself keeps its features and tag.
    """
    k = 0
    while k < len(places):
        last = k
        while (
            last + 1 < len(places)
            and places[last + 1] - places[last] <= 2 * _CONTEXT
            and places[last + 1] - places[k] < _SPAN
        ):
            last += 1
        start, stop = max(0, places[k] - _CONTEXT), min(n, places[last] + _CONTEXT + 1)
        own: list = [()] * (stop - start)
        own_tags = [0] * (stop - start)
        for j in range(bisect_left(places, start), bisect_left(places, stop)):
            own[places[j] - start], own_tags[places[j] - start] = tuple(found[j]), tags[j]
        yield own, own_tags
        k = last + 1


def _distinct_stretches(compact: DataFrame, strong: set[int]) -> list[tuple[list[tuple[int, ...]], list[int], int]]:
    """(features, tags, count) of the stretches; tasks sum their own first."""
    spread = compact.sparkSession.sparkContext.broadcast(frozenset(strong))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def summed() -> pd.DataFrame:
            rows = [([list(f) for f in own], list(tags), n) for (own, tags), n in seen.items()]
            return pd.DataFrame(rows, columns=["own", "tags", "n"])

        for frame in frames:
            for n, places, found, toxic in zip(frame["n"], frame["places"], frame["found"], frame["toxic"]):
                tags = [int(bool(toxic) and not spread.value.isdisjoint(f)) for f in found]
                for own, own_tags in _stretches(list(places), [tuple(map(int, f)) for f in found], n, tags):
                    seen[tuple(own), tuple(own_tags)] += 1
                if len(seen) > 100_000:
                    yield summed()
                    seen = Counter()
        if seen:
            yield summed()

    schema = "own array<array<int>>, tags array<int>, n long"
    summed = compact.filter(F.size("places") > 0).mapInPandas(cut, schema).groupBy("own", "tags").agg(F.sum("n").alias("n"))
    rows = [([tuple(f) for f in r["own"]], list(r["tags"]), r["n"]) for r in summed.collect()]
    # One order of the sums, whatever order the tasks end in.
    return sorted(rows, key=lambda r: (r[0], r[1]))


def _summaries(compact: DataFrame, model: Field) -> list:
    """What the sampled documents' scores are made of, equal ones counted."""
    spread = compact.sparkSession.sparkContext.broadcast(model)

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(spread.value)
        for frame in frames:
            parts = [
                _summary(tagger.marginals(n, list(places), [tuple(f) for f in found]) if len(places) else [])
                for n, places, found in zip(frame["n"], frame["places"], frame["found"])
            ]
            yield pd.DataFrame({"parts": [list(map(float, p)) for p in parts], "toxic": frame["toxic"]})

    rows = compact.mapInPandas(summarise, "parts array<double>, toxic int").groupBy("parts", "toxic").count()
    return sorted(((r["parts"], r["toxic"], r["count"]) for r in rows.collect()), key=lambda r: (r[0], r[1]))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Field:
    """The field for a table and its labels."""
    sample = settle(labelled_sample(labels, most), "labels")
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "is_toxic")
    rows = settle(joined, "sample")
    classes = {r["is_toxic"]: r["count"] for r in rows.groupBy("is_toxic").count().collect()}
    toxic, total = classes.get(1, 0), sum(classes.values())
    if not toxic or toxic == total:
        share = toxic / total if total else 0.0
        return Field(scale=(math.log(share / (1 - share)) if 0 < share < 1 else 40.0 if share else -40.0, 0.0, 0.0, 0.0))
    numbers, strong = _choose(rows)
    compact = _compact(rows, numbers)
    stretches = _distinct_stretches(compact, strong)
    model = train(stretches, numbers) if stretches else Field()
    summaries = _summaries(compact, model)
    # A little of either class without any featured word, so that neither is unheard of.
    parts = np.array([*(p for p, _, _ in summaries), _summary([]), _summary([])])
    labels_of = np.array([*(t for _, t, _ in summaries), 1, 0], dtype=float)
    weight = np.array([*(float(n) for _, _, n in summaries), 0.1, 0.9])
    model.scale = _fit_scale(parts, labels_of, weight)
    return model


SCORED = "score double, spans array<struct<start:int,end:int,marginal:double>>"


def score_documents(docs: DataFrame, model: Field, *others: str) -> DataFrame:
    """``score`` and ``spans`` of each text, beside doc_id and ``others``."""
    kept = docs.select("doc_id", *(f"`{c}`" for c in others), "text")
    names = [c for c in kept.columns if c != "text"]
    spread = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names), SCORED])

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(spread.value)
        for frame in small_batches(frames, "text"):
            scores, spans = [], []
            for text in frame["text"]:
                _, places, _, marginals = tagger.tag(text)
                scores.append(tagger.score(marginals))
                spans.append(tagger.spans(text, places, marginals) if places else [])
            out = frame[names].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out.assign(score=scores, spans=[[dict(start=a, end=b, marginal=m) for a, b, m in s] for s in spans])

    return kept.mapInPandas(score, schema)


def is_toxic(score: Column) -> Column:
    return (score >= THRESHOLD).cast("int")


def flag_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of each document."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", is_toxic(F.col("score")).alias("predicted"), "spans"
    )


def keep_clean(docs: DataFrame, model: Field) -> DataFrame:
    """The rows of ``docs`` that are not toxic, as they were.

    Rows pass through the scoring tasks as Arrow batches, so any column of any
    kind stays what it is.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(spread.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            keep = [tagger.score(tagger.tag(text.as_py())[3]) < THRESHOLD for text in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
