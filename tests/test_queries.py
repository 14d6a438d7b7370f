"""Every registered query next to its SQL counterpart, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import check_engine, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF_DIR)


OWN = sorted(contract._QUERIES | contract._DEEP_QUERIES)


def test_every_query_has_a_counterpart():
    assert set(OWN) <= set(contract.queries())
    assert set(OWN) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", OWN)
def test_same_rows(spark, engine, name):
    assert differences(spark, engine, SF_DIR, name) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
