"""Grouping of spelling variants by pairs of trie nodes.

A word's prefixes are nodes of a trie, its suffixes nodes of the trie of the
reversed words. A node's number is mixed from its parent's number and its
letter, so tasks number the nodes of their words alike without asking each
other. A word has two kinds of pairs (prefix node, suffix node): those that
skip one letter, and those that skip none. Two words whose skipping pairs are
equal differ in that letter; a skipping pair that equals a pair without a skip
joins a word to the one it becomes without that letter, that is the other one
with a letter inserted. No other words are one edit apart. Members of a pair differ in one
letter, so a pair has at most as many as the alphabet has letters, and no pair
is hot. Numbers only find candidates: each is checked on both words.

Words are taken, counted and named by built-in functions; Python numbers the
nodes of the vocabulary. Defined results: a null or empty text has no words; a
null doc_id counts as the empty text in the hash that drops letters; rows of
one id and equal rows each count; a word of any length is handled, in as many
pairs as twice its letters; ties go to the smallest word in code-point order;
an empty table gives no words. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.operators.lookup import broadcast_if_small
from daymart.operators.scratch import settle

MIN_LETTERS = 5
MIN_COUNT = 3
#: One run in so many loses a letter, by its hash.
DROP_EVERY = 97
#: A form is so many times as frequent as its variant, at least.
FORM_RATIO = 2
_RUN = f"[A-Za-zÀ-ÿ]{{{MIN_LETTERS},}}+"
_ROOT, _LETTER, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9
_LETTERS_AT_ONCE = 1 << 18
PAIRS = "prefix long, suffix long, at int, letters int, skips boolean, first boolean, id long"


def vocabulary(docs: DataFrame) -> DataFrame:
    """id, word and count n of each word; stored, so that ids stay."""
    # Shorter runs give no word, as a letter is only ever dropped.
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(key.alias("key"), F.explode(F.regexp_extract_all(lowered, F.lit(_RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("key", F.lit(":"), "run")).alias("h"))
    at = F.expr("cast(h % char_length(run) as int)")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % DROP_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.char_length("word") >= MIN_LETTERS)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)
    return settle(counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def _child(parent: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Numbers of the nodes below ``parent`` by ``letter``."""
    x = parent + (letter + np.uint64(1)) * np.uint64(_LETTER)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_STEP)
    return x ^ (x >> np.uint64(29))


def node_numbers(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters and lengths of words; places of their nodes; prefix and suffix nodes.

    A word of n letters has n + 1 nodes of either kind, from its place on.
    """
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes) - sizes
    places = starts + np.arange(len(words))
    prefix = np.full(len(letters) + len(words), _ROOT, dtype=np.uint64)
    suffix = prefix.copy()
    longest_first = np.argsort(-sizes, kind="stable")
    longer = np.sort(sizes)
    for depth in range(int(sizes.max(initial=0))):
        w = longest_first[: len(words) - np.searchsorted(longer, depth, "right")]
        prefix[places[w] + depth + 1] = _child(prefix[places[w] + depth], letters[starts[w] + depth])
        end = sizes[w] - depth
        suffix[places[w] + end - 1] = _child(suffix[places[w] + end], letters[starts[w] + end - 1])
    return letters, sizes, places, prefix, suffix


def pair_rows(ids: np.ndarray, words: list[str]) -> pd.DataFrame:
    """The pairs of words: ``letters`` left and right together, met ``at`` a place."""
    letters, sizes, places, prefix, suffix = node_numbers(words)
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = places[word] + at
    # Of equal letters in a row, dropping any gives the same word: the first stands for all.
    first = np.ones(len(letters), dtype=bool)
    first[1:] = (letters[1:] != letters[:-1]) | (at[1:] == 0)
    skipping = {
        "prefix": prefix[place].view(np.int64),
        "suffix": suffix[place + 1].view(np.int64),
        "at": at.astype(np.int32),
        "letters": (sizes[word] - 1).astype(np.int32),
        "skips": True,
        "first": first,
        "id": ids[word],
    }
    word = np.repeat(np.arange(len(words)), sizes + 1)
    whole = {
        "prefix": prefix.view(np.int64),
        "suffix": suffix.view(np.int64),
        "at": (np.arange(len(prefix)) - places[word]).astype(np.int32),
        "letters": sizes[word].astype(np.int32),
        "skips": False,
        "first": True,
        "id": ids[word],
    }
    return pd.concat([pd.DataFrame(skipping), pd.DataFrame(whole)], ignore_index=True)


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ids, words = frame["id"].to_numpy(), frame["word"].tolist()
        a, held = 0, 0
        for b, word in enumerate(words, 1):
            held += len(word)
            if held >= _LETTERS_AT_ONCE or b == len(words):
                yield pair_rows(ids[a:b], words[a:b])
                a, held = b, 0


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of stored ``words`` (id, word, n) one edit apart, once either way.

    Columns id, and near_id, near_word, near_n of the other word.
    """
    rows = words.select("id", "word").mapInPandas(_batches, PAIRS)
    member = F.struct("skips", "first", "id").alias("member")
    met = rows.groupBy("prefix", "suffix", "at", "letters").agg(F.collect_list(member).alias("members"))
    met = met.filter(F.size("members") > 1)
    one = met.select("at", "members", F.explode(F.filter("members", lambda m: m["skips"])).alias("a"))
    two = one.select("at", "a", F.explode("members").alias("b"))
    replaced = F.col("b.skips") & (F.col("a.id") < F.col("b.id"))
    dropped = ~F.col("b.skips") & F.col("a.first")
    found = two.filter(replaced | dropped)
    found = found.select("at", F.col("a.id").alias("id"), F.col("b.id").alias("near_id"), F.col("b.skips").alias("same_length"))
    other = words.select(F.col("id").alias("near_id"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    texts = found.join(broadcast_if_small(words), "id").join(broadcast_if_small(other), "near_id")
    gap = F.when(F.col("same_length"), F.col("at") + 2).otherwise(F.col("at") + 1)
    left = F.substring("word", F.lit(1), F.col("at")) == F.substring("near_word", F.lit(1), F.col("at"))
    right = F.substring("word", F.col("at") + 2, F.char_length("word")) == F.substring("near_word", gap, F.char_length("near_word"))
    sizes = F.char_length("word") - F.char_length("near_word") == F.when(F.col("same_length"), 0).otherwise(1)
    pairs = settle(texts.filter(left & right & sizes).select("id", "word", "n", "near_id", "near_word", "near_n"), "near-pairs")
    back = pairs.select(F.col("near_id").alias("id"), F.col("id").alias("near_id"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    return pairs.select("id", "near_id", "near_word", "near_n").unionByName(back)


def _roots(forms: DataFrame) -> DataFrame:
    """id and root of each row of stored ``forms`` (id, form_id): forms followed to the last.

    A form is at least twice as frequent as its word, so ways are short and end;
    each round doubles the steps taken.
    """
    roots = forms.select("id", F.col("form_id").alias("root"))
    while True:
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        stepped = settle(roots.join(further, "root", "left").select("id", "root", "next"), "roots")
        roots = stepped.select("id", F.coalesce("next", "root").alias("root"))
        if stepped.filter(F.col("next").isNotNull()).isEmpty():
            return roots


def group_spellings(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``docs``."""
    words = vocabulary(docs)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word", "near_id")).alias("best")
    near = near_pairs(words).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = words.join(near, "id", "left")
    is_form = -F.col("best.less") >= FORM_RATIO * F.col("n")
    rows = rows.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near_word")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
        F.when(is_form, F.col("best.near_id")).alias("form_id"),
    )
    rows = settle(rows, "forms")
    roots = _roots(rows.filter(F.col("form_id").isNotNull()).select("id", "form_id"))
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = roots.join(names, "root").select("id", "root_word")
    out = rows.join(named, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
