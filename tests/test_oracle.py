"""Every registered query against its DuckDB oracle on the smallest scale factor."""
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare

QUERIES = queries()
ORACLE = oracle_sql()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "week_rank" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, name):
    compare(QUERIES[name](spark, sf), ORACLE[name], sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
