"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from recordloom.plans.registry import QUERIES, SQL
from tests.compare import check, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert check(QUERIES[name](spark, SF_DIR), duck, SQL[name]) > 0


def test_flagship(spark):
    assert entry.entry(spark).columns == [
        "flag", "inventory_id", "price", "quantity", "id", "parent_id", "operation_id",
    ]


def test_entry_holds_all_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
