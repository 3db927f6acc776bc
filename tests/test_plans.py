"""Plan shapes that have to hold at any size."""

import contextlib
import io
import os

import pytest

from millrace.crosscheck.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    """Everything is too large to broadcast, as it will be."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream_", "layers_", "raw_load"))])
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", ["stg_customers", "stg_payments", "latest_run_status", "dim_customer_scd2"])
def test_latest_row_is_limited_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_merge_shuffles_each_side_once(spark, no_broadcast):
    text = plan(QUERIES["stg_billing_merge"](spark, FOLDER))
    tree = text[: text.index("(1) Scan")]
    assert tree.count("Exchange") == 2


def test_small_merge_leaves_the_target_where_it_is(spark, no_broadcast):
    text = plan(QUERIES["stg_cdr_insert_absent_small"](spark, FOLDER))
    tree = text[: text.index("(1) Scan")]
    assert "SortMergeJoin" not in tree and "BroadcastHashJoin" in tree


def test_row_filter_reaches_the_scan(spark):
    text = plan(QUERIES["usage_daily_south"](spark, FOLDER))
    assert "EqualTo(region,SOUTH)" in text


def test_report_reads_only_its_columns(spark):
    text = plan(QUERIES["monthly_summary"](spark, FOLDER))
    assert "national_id" not in text and "origin_number" not in text


def test_payments_are_summed_before_the_join(spark, no_broadcast):
    assert "partial_sum(amount" in plan(QUERIES["revenue_monthly"](spark, FOLDER))


def test_a_day_of_the_run_log_is_one_month_of_files(spark):
    text = plan(QUERIES["daily_summary"](spark, FOLDER))
    assert "run_month" in text[text.index("PartitionFilters") :].split("\n")[0] and "EqualTo(run_date," in text


@pytest.mark.parametrize("name", ["daily_run_stats", "daily_summary", "latest_run_status"])
def test_run_statistics_sort_no_texts(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, FOLDER))
