"""Every registered query against its DuckDB oracle (row count, columns, value hash).

Runs on sf0.001 by default (set ORACLE_SF_DIR for another scale); the driver
runs the same comparison at sf0.01.
"""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, sf_dir, key):
    r = compare(spark, con, key, sf_dir, QUERIES[key], ORACLE[key])
    assert r["ok"], r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.count() >= 0
    assert len(df.columns) == len(set(df.columns))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "name", "price", "category", "stock", "units_sold", "avg_rating",
                          "loyalty_points_earned"]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
