import os

import pyarrow.parquet as pq

from millrace.crosscheck import inputs
from millrace.crosscheck.queries import QUERIES


def customers(spark, folder, n):
    made = spark.range(n).selectExpr("id + 1 AS c_custkey", "concat('Customer ', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey")
    made.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    firms = spark.range(20).selectExpr("id + 1 AS s_suppkey", "concat('Supplier ', id) AS s_name", "cast(id % 25 AS int) AS s_nationkey")
    firms.coalesce(1).write.parquet(f"{folder}/supplier.parquet")


def test_a_stored_file_is_bounded_whatever_the_tables_row_groups(spark, tmp_path):
    customers(spark, tmp_path, 100_000)
    rows = inputs.raw_rows(spark, str(tmp_path), inputs.FEEDS["customers"])
    sizes = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in rows.inputFiles()]
    assert sum(sizes) == 200_020 and max(sizes) * len(inputs.FEEDS["customers"].columns) <= inputs.FILE_VALUES


def test_rows_read_once_are_the_stored_ones(spark, tmp_path, rows):
    customers(spark, tmp_path, 300)
    feed = inputs.FEEDS["customers"]
    for loads in (1, 2):
        kept, once = (inputs.raw_rows(spark, str(tmp_path), feed, loads, once=o) for o in (False, True))
        assert rows(kept) == rows(once) and kept.columns == once.columns


def test_a_reconciliation_of_one_feed_stores_no_raw_rows(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        return
    inputs._STORED.clear()
    QUERIES["dq_reconcile_summary"](spark, folder).collect()
    QUERIES["dq_open_errors"](spark, folder)
    assert not inputs._STORED


def test_merges_are_counted_without_being_stored(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        return
    QUERIES["merge_counts"](spark, folder)
    assert not [name for _, _, name in inputs._STORED if name.startswith("merged/")]


def test_curated_facts_store_no_steps_of_their_own(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        return
    inputs._STORED.clear()
    QUERIES["monthly_summary"](spark, folder)
    facts = ("billing", "payments", "cdr")
    names = [name for _, _, name in inputs._STORED]
    assert {"raw/payments", "curated/fact_payments"} <= set(names)
    assert not [n for n in names if n.startswith(("staging/", "merged/", "first/")) and any(f in n for f in facts)]
