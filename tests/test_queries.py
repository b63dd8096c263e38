"""Every registered query against its SQL on the smallest data, and the driver contract."""

import os

import pytest

import oracle
from foliograph.catalog import load

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(DIRECTORY)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIRECTORY)
    if name in ORACLES:
        problems, _ = oracle.compare(df, duck, ORACLES[name])
        assert not problems, problems
    else:
        assert df.count() > 0


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
    assert len(QUERIES) - len(ORACLES) <= 2
