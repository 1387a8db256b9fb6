"""Every registered query of the warehouse against its oracle SQL on the smallest tables."""

from pathlib import Path

import pytest
from oracle_check import compare

import __spark_entry__ as contract
from millrace.plans.catalog import QUERIES
from millrace.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables absent")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, name):
    rows, difference = compare(spark, SF_DIR, QUERIES[name], ORACLE[name])
    assert difference == ""
    assert rows > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[:6] == ["stt", "edt", "vc", "ch", "ar", "is_new"]
