"""Cleaning a corpus: rules, toxicity, SimHash near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and its result is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of
``docs``, in their order. Texts of any length are taken whole; null and empty
texts have no words, which the rules reject; rows of one text are near-duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm.mixing import mixed_documents
from daymart.llm.packing import pack
from daymart.llm.quality_rules import fit_rules
from daymart.llm.quality_rules import kept_documents as keep_by_rules
from daymart.llm.simhash import kept_documents as keep_one_of_each
from daymart.llm.toxicity import fit, keep_clean
from daymart.operators.scratch import scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned list keep."""
    return keep_by_rules(docs, fit_rules(docs, _labels(spark, sf_dir)))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold."""
    return keep_clean(docs, fit(docs, _labels(spark, sf_dir)))


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 3 or fewer differing bits."""
    return keep_one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated as often as that asks."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of a power of two of tokens, each of one document, with their ids."""
    return pack(docs, tokenizer="byte_bpe_50k.json", spaced=True, end_id=1, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("simhash_near_duplicates", simhash_near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

#: Fields, hashes of texts and token ids are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    # A row's ids are told by their checksum.
    return docs.select(*(F.col(c) for c in docs.columns if c != "ids"))
