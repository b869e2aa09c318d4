import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from odd_rows import ODD_TEXTS  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")




@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties and repeated rows, clashing columns."""
    rows = [(k, t, "src" + str(k % 3) if k % 4 else None, len(t or "")) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id", None, None), (None, "no id", None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    names = ("score", "kept", "size", "node", "key", "shard", "rule", "path", "part", "lang", "_text", "words")
    return table.withColumns({c: F.lit("x") for c in names}).coalesce(2)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(5, 0, 1), (5, 1, 0), (9, 0, 0), (10, 1, 1), (None, 1, 1), (11, None, None), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
