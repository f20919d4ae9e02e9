"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from ledgerlight.plans import registry
from tools.check_oracle import check_one, duck_connection

SF = "/root/testdata/sf0.001"
registry.load_all()
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    missing = set(registry.QUERIES) - set(registry.ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    status, msg, _ = check_one(spark, con, SF, name, registry.QUERIES[name], registry.ORACLE.get(name))
    assert status == "OK", msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["retailer", "ty_sales", "ly_sales", "wk_change", "wk_pct"]
