"""Every query with an oracle matches DuckDB on the same Parquet tables;
every query without one runs and returns rows."""

import pytest

from tests.conftest import SF_SMALL
from vigil.plans import catalog as _c

_c.load_all()
# test_models and test_registry cover them
SLOW = {"score_gbt", "train_flow", "score_rf", "tree_importance", "tree_explanations", "retrain_flow"}


@pytest.fixture(scope="module")
def con():
    from vigil.testing import duckdb_connection
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(_c.ORACLE))
def test_query_matches_oracle(spark, con, name):
    from vigil.testing import compare
    df = _c.QUERIES[name](spark, SF_SMALL)
    r = compare(df, con, _c.ORACLE[name])
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["value_mismatches"] == 0, r["examples"]


@pytest.mark.parametrize("name", sorted(set(_c.QUERIES) - set(_c.ORACLE) - SLOW))
def test_rows_only_query_runs(spark, name):
    assert _c.QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
