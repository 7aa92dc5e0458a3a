"""Every registered query against its DuckDB oracle (small fixture), and
every query without one at least runs."""

import pytest

from conftest import SF_SMALL
from stockcast.plans.catalog import REGISTRY
from stockcast.plans.check import compare, duckdb_connection

WITH_ORACLE = sorted(k for k, q in REGISTRY.items() if q.oracle)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_query_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    res = compare(spark, con, name, q.run, q.oracle, SF_SMALL)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_every_query_has_an_oracle_or_runs(spark):
    for name, q in REGISTRY.items():
        if not q.oracle:
            assert q.run(spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
