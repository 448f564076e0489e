"""Every registered query at the smallest scale against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
SLOW = {"fit_rasch", "fit_2pl", "fit_bifactor", "fit_2pl_params", "model_stats", "model_stats_complete"}  # covered by test_irt


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES) - SLOW))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 1
    else:
        problem = compare(df, con, sql)
        assert problem is None, problem


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 36 and set(rows[0].asDict()) == {"table_name", "domain", "n_items"}
