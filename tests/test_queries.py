"""Every query of the library's own catalog against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as contract
import compare
from clickwell.plans.catalog import QUERIES
from clickwell.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    got = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    want = compare.oracle(SF_DIR, ORACLE[name])
    assert got == want
    assert sum(got[1].values()) > 0
