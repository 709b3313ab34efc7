"""The queries that have SQL, against it."""

import oracle
import pytest

from flatloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), SQL[name]) == []
