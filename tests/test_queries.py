"""Every registered query against its SQL; FIELDLEDGER_SF_DIR picks another scale."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from fieldledger.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("FIELDLEDGER_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, con, ORACLES[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["PERIOD", "ORG_UNIT", "DX_UID"]
    assert df.limit(1).count() == 1
