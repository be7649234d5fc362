"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as entry
from alloy.plans import catalog
from sf_dirs import SF_SMALL
from oracle_harness import compare, duck

SLOW = {"rf_gate"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in SLOW])
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, con)
    if name in entry.oracle_sql():
        assert res["ok"], res
    else:
        assert res["spark_rows"] >= 1


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["condition", "flag", "metric", "n", "mean"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_documented():
    missing = set(catalog.QUERIES) - set(entry.oracle_sql())
    assert not missing
