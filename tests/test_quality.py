import datetime as dt
import json

from pyspark.sql import functions as F

from millrace.feeds import FEEDS
from millrace.operators import quality as q
from millrace.plans import reports

AT = dt.datetime(2024, 1, 2, 8)
BILLING = FEEDS["billing"]
CTX = q.CheckContext(5, BILLING.validate_job, BILLING.name, BILLING.raw_table, AT)


def raw(spark, *changed, feed=BILLING, **usual):
    base = {c: None for c in feed.columns} | {feed.key: "i1", "source_file_name": "a.csv", "_load_ts": AT} | usual
    names = (*feed.columns, "source_file_name", "_load_ts")
    return spark.createDataFrame([tuple((base | c)[n] for n in names) for c in changed], feed.raw_schema)


def test_two_broken_rules_give_two_errors(spark, rows):
    df = raw(spark, {"invoice_date": "2024-02-30", "invoice_status": "VOID"}, {"invoice_status": None}, {"invoice_id": None})
    errors = q.rule_errors(df, BILLING.rules, BILLING.key, CTX)
    assert rows(errors, "rule_type", "column_name", "record_key", "failed_value", "error_reason") == [
        ("ACCEPTED_VALUES", "invoice_status", "i1", "VOID", "invoice_status not in (PAID, OPEN, OVERDUE)"),
        ("DATE_FORMAT", "invoice_date", "i1", "2024-02-30", "invoice_date is not a parseable date (expected YYYY-MM-DD)"),
        ("NOT_NULL", "invoice_id", None, None, "invoice_id is NULL"),
    ]
    record = json.loads(errors.where("column_name = 'invoice_status'").first().raw_record)
    assert record["invoice_status"] == "VOID" and "tax_amount" not in record


def test_summary_agrees_with_errors(spark):
    df = raw(spark, *[{"billing_period": p, "due_date": d} for p in ("2024-13", "2024-1", "2024-01\n", "2024-01", None) for d in ("x", "2024-01-01")])
    summary = {(r.rule_type, r.column_name): r for r in q.rule_summary(df, BILLING.rules, CTX).collect()}
    assert len(summary) == len(BILLING.rules)
    errors = q.rule_errors(df, BILLING.rules, BILLING.key, CTX).groupBy("rule_type", "column_name").count().collect()
    counted = {(r.rule_type, r.column_name): r["count"] for r in errors}
    for key, row in summary.items():
        assert row.records_checked == 10 and row.records_failed == counted.get(key, 0)
        assert row.check_status == ("FAIL" if row.records_failed else "PASS")
    assert summary[("DATE_FORMAT", "billing_period")].records_failed == 6


def test_roaming_flag_in_any_case(spark):
    cdr = FEEDS["cdr"]
    df = raw(spark, *[{"roaming_flag": f} for f in ("y", "N", "1", None)], feed=cdr, cdr_id="c")
    rule = next(r for r in cdr.rules if r.column == "roaming_flag")
    assert [r[0] for r in df.where(rule.broken()).select("roaming_flag").collect()] == ["1"]


def test_reconciliation(spark, rows):
    df = raw(spark, *[{"source_file_name": f} for f in ("a", "a", "b", "c", None)])
    counts = spark.createDataFrame([("a", 2), ("b", 2)], "source_file_name string, source_row_count bigint")
    recon = q.reconcile(df, counts, CTX)
    assert rows(recon, "source_file_name", "row_count_variance", "check_status") == [
        ("a", 0, "MATCH"), ("b", -1, "MISMATCH"), ("c", None, "SKIPPED"),
    ]
    assert rows(reports.count_mismatches(recon), "source_file_name") == [("b",)]
    assert rows(q.reconcile_summary(recon, CTX), "records_checked", "records_failed") == [(2, 1)]


def test_open_errors_leave_resolved_ones_out(spark):
    errors = q.rule_errors(raw(spark, {"invoice_status": "VOID"}, {"invoice_status": "NONE"}), BILLING.rules, BILLING.key, CTX)
    errors = errors.withColumn("is_resolved", F.col("failed_value") == "VOID")
    assert [r.failed_value for r in reports.open_validation_errors(errors).collect()] == ["NONE"]


def test_catalogue_lists_every_rule(spark):
    table = q.rules_table(spark, list(FEEDS.values()))
    assert table.count() == sum(len(f.rules) + 1 for f in FEEDS.values()) == 45


def test_since_limits_to_later_loads(spark):
    df = raw(spark, {}, {"_load_ts": AT + dt.timedelta(days=1)})
    assert q.since(df, AT).count() == 1 and q.since(df, None).count() == 2
