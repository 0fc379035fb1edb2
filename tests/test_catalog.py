"""Every registered query against its SQL, at the smallest scale factor."""

from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_match():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF)
    if name not in contract.oracle_sql():
        df.count()
        return
    rows, problems = compare(df, con, contract.oracle_sql()[name])
    assert not problems
    assert rows > 0


def test_entry(spark):
    assert "GDD_ASIA" in contract.entry(spark).columns
