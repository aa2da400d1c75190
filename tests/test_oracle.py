"""Every registered query against DuckDB (or rows only) on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["speaker", "n_pairs", "mean_distance"] and df.count() > 0
