"""Every registered query against its SQL at the smallest scale."""

import pytest
from conftest import SMALL
from parity import check, connect

import __spark_entry__ as spark_entry
from ledgerstar.catalogue import QUERIES
from ledgerstar.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert check(spark, con, SMALL, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_sort_order(spark):
    found = spark_entry.queries()["multi_key_sort"](spark, SMALL).collect()
    assert len(found) > 1000
    for a, b in zip(found, found[1:]):
        assert a.o_orderpriority <= b.o_orderpriority
        assert a.o_orderpriority < b.o_orderpriority or a.o_orderdate >= b.o_orderdate
