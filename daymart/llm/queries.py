"""Registered queries of the text operators, with SQL where it can say the same.

A query applies its operator to its whole table and derives the columns that
its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm.alignment import align_documents
from daymart.llm.ann import nearest
from daymart.llm.chosen_path import near_components
from daymart.llm.licenses import scan_documents
from daymart.llm.mixing import mix
from daymart.llm.packing import pack
from daymart.llm.quality_rules import fit_rules, judge
from daymart.llm.sharding import shard_documents
from daymart.llm.simhash import simhash_components
from daymart.llm.spelling import group_spellings
from daymart.llm.toxicity import flag_documents
from daymart.llm.warc import archived_pages
from daymart.llm.wavelet import token_documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op3_token_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_documents(docs, tokenizer="word_bpe_49k.json", spaced=False, end_id=2)


def op4_warc_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archived_pages(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = judge(docs, fit_rules(docs, _table(spark, sf_dir, "labels")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *counts, "base_failed", "kept", F.col("rule"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op7_pack_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pack(docs, tokenizer="byte_bpe_50k.json", spaced=True, end_id=1)


def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op9_shard_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(_table(spark, sf_dir, "documents"))


def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity_crf,
        op2_simhash_gray,
        op3_token_wavelet,
        op4_warc_splits,
        op5_decision_list,
        op6_mix_sources,
        op7_pack_binary,
        op8_posting_lists,
        op9_shard_ring,
        op10_license_index,
        op11_chosen_path,
        op12_token_alignment,
        op13_spelling_variants,
    )
}

#: Water-filling in closed form: sources in the order of cap by weight are
#: capped as long as the level of the rest would lift them above their cap.
MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS ord
  FROM documents),
sources AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY k),
weighted AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY k) - 1) % 3] AS DOUBLE) AS weight,
    source_size * CAST(2 AS DOUBLE) AS cap,
    CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS total
  FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
filled AS (
  SELECT *, level * weight > cap AS capped,
    total - sum(CASE WHEN level * weight > cap THEN cap ELSE 0 END) OVER () AS rest,
    sum(CASE WHEN level * weight > cap THEN 0 ELSE weight END) OVER () AS open_weight
  FROM levels),
targets AS (
  SELECT k, source_size, CASE WHEN capped THEN cap ELSE least(cap, weight * (rest / open_weight)) END AS target FROM filled),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT doc_id, size, source_size, target, whole,
    CAST(floor(target) AS BIGINT) - whole * source_size AS quota,
    CAST(coalesce(sum(size) OVER (PARTITION BY k ORDER BY ord, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS earlier
  FROM docs JOIN plan USING (k))
SELECT doc_id, size, source_size, target,
  CAST(whole * size + least(size, greatest(0, quota - earlier)) AS BIGINT) AS taken
FROM placed
"""

#: Distinct sets, all pairs that share a shingle, and what is reachable over links.
NEAR_SQL = r"""
WITH RECURSIVE
texts AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lists AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS shingles
  FROM texts),
sets AS (
  SELECT row_number() OVER () AS s, shingles, len(shingles) AS size, min(doc_id) AS first_id FROM lists WHERE len(shingles) > 0 GROUP BY shingles),
each AS (SELECT s, size, unnest(shingles) AS shingle FROM sets),
pairs AS (
  SELECT a.s AS a, b.s AS b FROM each a JOIN each b USING (shingle)
  WHERE a.s < b.s AND 100 * least(a.size, b.size) >= 85 * greatest(a.size, b.size)
  GROUP BY a.s, b.s, a.size, b.size HAVING 100 * count(*) >= 85 * (a.size + b.size - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT s AS node, s AS root FROM sets UNION SELECT edges.b, reach.root FROM reach JOIN edges ON reach.node = edges.a),
named AS (SELECT node, min(first_id) AS component_id FROM reach JOIN sets ON sets.s = reach.root GROUP BY node),
found AS (
  SELECT doc_id, len(lists.shingles) AS n_shingles, CASE WHEN len(lists.shingles) = 0 THEN doc_id ELSE component_id END AS component_id
  FROM lists LEFT JOIN sets USING (shingles) LEFT JOIN named ON named.node = sets.s)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM found
"""

#: Words one edit apart agree but for a letter at one place, or one becomes the other without a letter.
SPELLING_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b))),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
long_runs AS (SELECT k, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY k, run),
bytes AS (
  SELECT k, run, times, flatten(list_transform(string_split(k || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + unicode(c) % 64] END)) AS b
  FROM long_runs),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[1 + xor(c % 256, x)])), 4294967295) AS h
  FROM bytes, crc_table),
named AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
  FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM named WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)),
near AS (
  SELECT a.word, a.n, b.word AS w, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(w ORDER BY m DESC, w) AS w, max(m) AS m FROM near GROUP BY word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN w END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS here FROM forms
  UNION ALL SELECT way.word, form FROM way JOIN forms ON forms.word = way.here WHERE form IS NOT NULL),
ends AS (SELECT way.word, here AS root FROM way JOIN forms ON forms.word = way.here WHERE form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN ends USING (word)
"""

#: The other operators hash, encode or learn in ways that SQL cannot say; the
#: tests compare them with plain versions.
ORACLE_SQL: dict[str, str] = {
    "op6_mix_sources": MIX_SQL,
    "op11_chosen_path": NEAR_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
