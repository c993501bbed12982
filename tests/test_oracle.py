"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF001  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from sitegauge.oracle_sql import SQL  # noqa: E402
from sitegauge.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in SQL
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF001)


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert set(QUERIES) == set(SQL)
    # other queries may come with SQL or, where SQL can't say them, without
    assert set(QUERIES) <= set(e.queries())
    assert set(SQL) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["world", "site_id", "region", "owner_name", "year", "trimester", "is_ptd",
                          "total", "rank"]
