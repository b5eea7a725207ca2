"""Every registered core query against its SQL in DuckDB on the smallest tables."""

import pytest
from compare import compare

from changegrid.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLE_SQL:
        compare(spark, QUERIES[name], ORACLE_SQL[name], DATA)
    else:
        assert QUERIES[name](spark, DATA).columns
