import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

COLUMNS = "doc_id long, text string, row string, id long, start long, kept string, fingerprint string, block int, _key string, _id string, _own string"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents as a table whose other columns have names that the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "r", 1, 2, "k", "f", 3, "a", "b", None) for i, t in rows], COLUMNS)

    return make
