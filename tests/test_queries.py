import os

import pytest
from oracle import compare

from lexharbor.plans import general, reference

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = {**general.QUERIES, **reference.QUERIES}, {**general.SQL, **reference.SQL}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    compare(spark, DATA, QUERIES[name], SQL[name])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
