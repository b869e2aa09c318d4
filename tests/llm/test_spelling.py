"""Spelling variants against SQL and all pairs of words."""

import itertools

import sql_check

from daymart.llm import spelling
from daymart.llm.queries import ORACLE_SQL, QUERIES


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_registered_query_is_that_of_sql(spark):
    sf = "/root/testdata/sf0.001"
    with sql_check.connect(sf) as connection:
        sql_check.assert_same(QUERIES["op13_spelling_variants"](spark, sf), connection, ORACLE_SQL["op13_spelling_variants"])


def test_near_words_are_those_of_all_pairs(spark):
    words = ["aaaaa", "aaaaaa", "aaaab", "baaaa", "aabaa", "abcde", "abde", "xbcde", "abcdé", "éabcde", "abcdee", "bacde", "zzzzz", "abcdefg" * 900]
    words += ["".join(p) for p in itertools.product("pq", repeat=6)] + [("abcdefg" * 900)[:-1]]
    table = spark.createDataFrame([(k, w, 3 + k % 4) for k, w in enumerate(words)], "id long, word string, n long")
    rows = spelling.near_pairs(table).collect()
    found = sorted((words[r["id"]], r["near_word"]) for r in rows)
    assert found == sorted(p for p in itertools.permutations(words, 2) if one_edit(*p))
    assert all(r["near_n"] == 3 + words.index(r["near_word"]) % 4 for r in rows)


def test_forms_lead_to_the_last(spark):
    # Twice as often at each step: worda -> wordb -> wordbc, and ties go to the smallest word.
    counts = {"worda": 3, "wordb": 6, "wordbc": 12, "lonely": 5, "tiexx": 6, "tieax": 12, "tiebx": 12, "half": 50}
    rows = [(None, " ".join([w.upper()] * n)) for w, n in counts.items()]
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_spellings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    dropped = {w for w in counts if w not in found}
    assert dropped <= {"half"}
    assert found["worda"][:2] == ("wordb", "wordbc") and found["wordb"][:2] == ("wordbc", "wordbc")
    assert found["tiexx"][:2] == ("tieax", "tieax") and found["lonely"] == (None, "lonely", 5, 0, None)


def test_odd_rows(spark, odd_documents, no_documents):
    assert spelling.group_spellings(no_documents).collect() == []
    found = {r["word"]: r["n"] for r in spelling.group_spellings(odd_documents).collect()}
    assert found["words"] >= 3 and all(len(w) >= 5 and n >= 3 for w, n in found.items())
