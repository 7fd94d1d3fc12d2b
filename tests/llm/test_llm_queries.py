import os

import pytest
from oracle import compare

from lexharbor.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    compare(spark, DATA, QUERIES[name], SQL[name])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
