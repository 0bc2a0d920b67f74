"""Every registered query with an oracle matches DuckDB at sf0.001; the others run."""

import pytest

from tests.oracle_check import compare, duck

from quarry.catalog import ORACLES, QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    msg, *_ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert not msg, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "feature" in df.columns
