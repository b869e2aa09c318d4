"""Quality rules: a decision list learned from labelled statistics.

Statistics of a text are built-in expressions. A list of rules is learned by
sequential covering: a rule grows one threshold condition at a time, each the
one that sorts bad texts from good ones best, and is then pruned on rows that
did not help to grow it; what it covers is set aside and the next rule starts.
The list becomes one ordered conditional expression, so a table is judged in
one pass without a join.

Learning reads histograms only: for every statistic, how many good and bad
rows fall between neighbouring thresholds. Their size is fixed by the number
of statistics and thresholds. The labelled rows are at most ``MAX_LABELLED``,
taken in the order of a hash of their id.

Defined results: a null text has no words, fails the base rule and is not
kept; texts of any length are measured whole; repeated rows are judged each;
a label table that is empty, or has one class only, gives an empty list, which
keeps what the base rule keeps; an empty table gives no rows. Only doc_id and
text are read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.operators.scratch import settle

WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MAX_LABELLED = 50_000
MAX_RULES = 10
MAX_CONDITIONS = 4
THRESHOLDS = 24
MIN_PRECISION = 0.9
MIN_COVERED = 5

#: Statistics that conditions may use.
FEATURES = (
    "words",
    "mean_word",
    "symbol_rate",
    "dup_line_rate",
    "repeat_rate",
    "upper_rate",
    "digit_rate",
    "mark_rate",
    "words_a_line",
)


def _left(text: str, kept: str) -> Column:
    """Characters of ``text`` that are of the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def measure(docs: DataFrame, *others: str) -> DataFrame:
    """Counts and rates of each text, beside doc_id and ``others``.

    A step's arrays are columns of their own because later steps use them more
    than once.
    """
    kept = ["doc_id", *others]
    text = F.coalesce("text", F.lit("")).alias("_text")
    split = docs.select(*(f"`{c}`" for c in kept), text).select(
        *(f"`{c}`" for c in kept),
        "_text",
        F.array_remove(F.split("_text", GAP), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: F.rlike(line, F.lit(WORD))).alias("_lines"),
    )
    counted = split.select(
        *(f"`{c}`" for c in kept),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _left("_text", "#*$%&|<>").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _left("_text", "A-Z").alias("n_upper"),
        _left("_text", "0-9").alias("n_digits"),
        _left("_text", "!?;:").alias("n_marks"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    numbers = [c for c in counted.columns if c != "_hashes"]

    def window(i: Column) -> Column:
        return F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW)))

    starts = F.sequence(F.lit(0), F.size("_hashes") - WINDOW)
    none = F.array().cast("array<bigint>")
    windows = F.when(F.size("_hashes") > WINDOW, F.transform(starts, window)).otherwise(none)
    numbers = [f"`{c}`" for c in numbers]
    hashed = counted.select(*numbers, windows.alias("_windows"))
    # Nearly all texts repeat no window, and end here.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pair = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_pairs = hashed.select(*numbers, F.when(repeats, pair).alias("_pairs"))

    def shared(p: Column, k: Column) -> Column:
        before, after = F.get("_pairs", k - 1)["h"], F.get("_pairs", k + 1)["h"]
        return F.coalesce(before == p["h"], F.lit(False)) | F.coalesce(after == p["h"], F.lit(False))

    found = F.sort_array(F.transform(F.filter("_pairs", shared), lambda p: p["i"]))
    places = sorted_pairs.select(*numbers, found.alias("_found"))
    # A word belongs to the last window that begins before or at it.
    reach = F.transform("_found", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_found", k + 1) - s, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(reach, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    # A filter on a count stays above this step; pushed down it would have the
    # arrays worked out again within each other.
    counts = F.inline(F.array(F.struct(*numbers[len(kept) :], covered.alias("n_repeat_words"))))
    return places.select(*numbers[: len(kept)], counts)


def _rate(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    """The statistics that conditions use, from the counts of ``measure``."""
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": _rate("word_chars", "n_words"),
        "symbol_rate": _rate("n_symbols", "word_chars"),
        "dup_line_rate": _rate("n_dup_lines", "n_lines"),
        "repeat_rate": _rate("n_repeat_words", "n_words"),
        "upper_rate": _rate("n_upper", "word_chars"),
        "digit_rate": _rate("n_digits", "word_chars"),
        "mark_rate": _rate("n_marks", "word_chars"),
        "words_a_line": _rate("n_words", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class Rule:
    conditions: list[Condition] = field(default_factory=list)
    bad: int = 0
    good: int = 0

    def column(self) -> Column:
        return reduce(and_, (c.column() for c in self.conditions))

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.conditions))} -> reject ({self.bad} bad, {self.good} good)"


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, null when none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.column(), F.lit(number)).otherwise(out)
    return out


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """FOIL's gain of a condition that leaves ``bad`` and ``good`` rows."""
    if bad == 0:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of every statistic, over all rows and over the bad ones."""
    parts = [k / THRESHOLDS for k in range(THRESHOLDS)]
    wanted = []
    for name in FEATURES:
        for tag, value in (("all", F.col(name)), ("bad", F.when(F.col("bad") == 1, F.col(name)))):
            wanted.append(F.percentile_approx(value, parts, 2000).alias(f"{name}:{tag}"))
    found = rows.agg(*wanted).first().asDict()
    return {n: sorted({*(found[f"{n}:all"] or []), *(found[f"{n}:bad"] or [])}) for n in FEATURES}


def _bin(name: str, thresholds: list[float]) -> Column:
    """How many thresholds of a statistic lie below its value."""
    below = F.filter(F.array(*map(F.lit, thresholds)), lambda t: t < F.col(name))
    return F.size(below).alias(f"bin_{name}")


def _histograms(rows: DataFrame) -> tuple[dict, dict]:
    """Rows by statistic, bin and class; for growing and for pruning."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"bin_{n}").alias("bin")) for n in FEATURES)))
    counts = rows.select("bad", "prune", pairs.alias("p")).groupBy("p.name", "p.bin", "bad", "prune").count()
    grow: dict = defaultdict(int)
    prune: dict = defaultdict(int)
    for name, at, bad, is_prune, n in counts.collect():
        (prune if is_prune else grow)[name, at, bad] += n
    return grow, prune


def _sides(counts: dict, name: str, bins: int):
    """(above, bin, bad, good) for both sides of every threshold of a statistic."""
    bad = [counts[name, b, 1] for b in range(bins + 1)]
    good = [counts[name, b, 0] for b in range(bins + 1)]
    for b in range(bins):
        low = sum(bad[: b + 1]), sum(good[: b + 1])
        yield False, b, *low
        yield True, b, sum(bad) - low[0], sum(good) - low[1]


def _holds(choice: tuple[str, bool, int]) -> Column:
    name, above, at = choice
    return F.col(f"bin_{name}") > at if above else F.col(f"bin_{name}") <= at


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[list, list]:
    """Conditions of one rule, and the pruning rows (bad, good) after each."""
    chosen: list[tuple[str, bool, int]] = []
    judged: list[tuple[int, int]] = []
    while len(chosen) < MAX_CONDITIONS:
        left = rows.filter(reduce(and_, map(_holds, chosen))) if chosen else rows
        grow, prune = _histograms(left)
        first = FEATURES[0]
        total = [sum(grow[first, b, c] for b in range(len(thresholds[first]) + 1)) for c in (1, 0)]
        if total[0] < MIN_COVERED or total[1] == 0:
            break
        best, best_gain = None, 0.0
        for name in FEATURES:
            for above, at, bad, good in _sides(grow, name, len(thresholds[name])):
                gain = _gain(bad, good, *total) if bad >= MIN_COVERED else -math.inf
                if gain > best_gain:
                    best, best_gain = (name, above, at), gain
        if best is None:
            break
        chosen.append(best)
        name, above, at = best
        sides = _sides(prune, name, len(thresholds[name]))
        judged.append(next((bad, good) for a, b, bad, good in sides if (a, b) == (above, at)))
    return chosen, judged


def learn_rules(measured: DataFrame) -> list[Rule]:
    """The decision list from measured rows with ``bad`` (1 or 0)."""
    rows = settle(measured.select("doc_id", "bad", *(v.alias(n) for n, v in features().items())), "labelled")
    thresholds = _thresholds(rows)
    if not all(thresholds.values()):
        return []
    bins = [_bin(n, thresholds[n]) for n in FEATURES]
    prune = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")
    binned = settle(rows.select("bad", prune, *bins).coalesce(8), "binned")
    rules: list[Rule] = []
    left = binned
    for _ in range(MAX_RULES):
        chosen, judged = _grow(left, thresholds)
        # Keep the conditions up to the point where the pruning rows like it best.
        worth = [(bad - good) / (bad + good) if bad + good else -1.0 for bad, good in judged]
        if not worth:
            break
        keep = worth.index(max(worth)) + 1
        bad, good = judged[keep - 1]
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            break
        conditions = [Condition(n, above, thresholds[n][at]) for n, above, at in chosen[:keep]]
        rules.append(Rule(conditions, bad, good))
        left = left.filter(~reduce(and_, map(_holds, chosen[:keep])))
    return rules


def labelled_sample(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` labelled ids, the first by hash; bad when any label says so."""
    rows = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
    ids = rows.agg((1 - F.min("quality")).cast("int").alias("bad"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit_rules(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[Rule]:
    """Learn the list for a table; the ids sampled are few enough to broadcast."""
    sample = settle(labelled_sample(labels, most), "labels")
    # Rows that the base rule rejects need no learned one.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return learn_rules(measure(rows, "bad").filter(~base_failed()))


def judge(docs: DataFrame, rules: list[Rule], *others: str) -> DataFrame:
    """Counts, base_failed, rule (the first that rejects) and kept of each row."""
    rows = measure(docs, *others).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def kept_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that the base rule and the list keep, as they were."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = docs.select(F.col("doc_id"), F.col("text"), whole)
    return judge(rows, rules, "_row").filter("kept").select("_row.*")
