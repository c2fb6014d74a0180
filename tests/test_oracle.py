"""Every registered query against its DuckDB oracle on the small test data."""

import pytest

import __spark_entry__ as E
from blotter.plans import catalog
from oracle_check import compare, duck

KEYS = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    sdf = E.queries()[key](spark, sf_small).toPandas()
    ddf = con.execute(E.oracle_sql()[key]).df()
    res = compare(sdf, ddf, catalog.ORDERS.get(key, ()))
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["area_id", "area_name", "crime_count", "violent_count",
                          "avg_reporting_delay_days", "median_reporting_delay_days", "violent_share"]
