"""Every registered query with SQL against DuckDB on the same Parquet tables
(sf0.01): same columns, row count and multiset of rows."""

import pytest

from paths import SF001
from oracle_compare import compare, duck
from tidemark.plans import registry as R


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(R.ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(R.QUERIES[name](spark, SF001), R.ORACLE[name], con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(R.QUERIES) - set(R.ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert R.QUERIES[name](spark, SF001).count() > 0
