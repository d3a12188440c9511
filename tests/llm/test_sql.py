"""Queries of this package that SQL can express, on the whole tables."""

import pytest

from tests.conftest import SF_SMALL
from vigil.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    from vigil.testing import compare, duckdb_connection
    r = compare(queries.QUERIES[name](spark, SF_SMALL), duckdb_connection(SF_SMALL), queries.ORACLE[name])
    assert r["columns_match"] and r["spark_rows"] == r["oracle_rows"] > 0
    assert r["value_mismatches"] == 0, r["examples"]
