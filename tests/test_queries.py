"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from millrace.crosscheck.oracles import ORACLES as SQL
from millrace.crosscheck.queries import QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["monthly_summary", "stg_payments", "dim_customer_scd2"])
def test_results_do_not_hang_on_shuffle_partitions(spark, con, name):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
