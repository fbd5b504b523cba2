"""Every registered query against its DuckDB oracle on the small tables."""
import pytest

import __spark_entry__ as E
from layerkit.plans.registry import NAMES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

QUERIES = {k: v for k, v in E.queries().items() if k in NAMES}
SQL = {k: v for k, v in E.oracle_sql().items() if k in NAMES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con)
    assert res["ok"], res
