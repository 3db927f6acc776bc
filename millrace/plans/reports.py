"""The eleven report views, each a function of the tables it reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import percent, to_date_or_null
from millrace.operators.latest import latest_by_key, newest_first
from millrace.operators.runlog import DAY_TOTALS

Tables = Mapping[str, DataFrame]


def customer_current(t: Tables) -> DataFrame:
    return t["dim_customer"].where(F.col("is_current"))


def paid_by_invoice(payments: DataFrame) -> DataFrame:
    """Successful payments summed before they meet the invoices."""
    return payments.where("payment_status = 'SUCCESS'").groupBy("invoice_id").agg(F.sum("amount").alias("paid_amount"))


def usage_by_month(cdr: DataFrame) -> DataFrame:
    """Usage per customer and month, the month kept as its first day: a narrow key."""
    kind = F.col("call_type")
    return cdr.groupBy("customer_id", F.trunc("usage_date", "month").alias("_month")).agg(
        F.sum(F.when(kind == "DATA", F.col("data_volume_mb")).otherwise(0)).alias("total_data_mb"),
        F.sum(F.when(kind == "VOICE", F.col("duration_seconds")).otherwise(0)).alias("total_voice_seconds"),
        F.count_if(kind == "SMS").alias("total_sms"),
    )


def billed(t: Tables) -> DataFrame:
    """Invoices of current customers, with what was paid on them (null when nothing was)."""
    invoices = t["fact_billing"].select("invoice_id", "customer_id", "billing_period", "total_amount")
    customers = customer_current(t).select("customer_id", "region", "customer_segment")
    return invoices.join(paid_by_invoice(t["fact_payments"]), "invoice_id", "left").join(customers, "customer_id")


def customer_monthly_summary(t: Tables) -> DataFrame:
    """One row per invoice; two invoices of a month both show the month's usage.

    A billing period that is no month has no usage.
    """
    usage = usage_by_month(t["fact_cdr_usage"])
    return (
        billed(t)
        .withColumn("_month", to_date_or_null("billing_period", "yyyy-MM"))
        .join(usage, ["customer_id", "_month"], "left")
        .select(
            "customer_id",
            "billing_period",
            "region",
            "customer_segment",
            F.col("total_amount").alias("invoice_amount"),
            "paid_amount",
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total_data_mb", "total_voice_seconds", "total_sms")],
        )
    )


def regional_usage_daily(t: Tables, approximate: bool = False) -> DataFrame:
    """Sessions per day, region and call type; `approximate` estimates the customer count."""
    customers = F.approx_count_distinct("customer_id") if approximate else F.count_distinct("customer_id")
    return t["fact_cdr_usage"].groupBy("usage_date", "region", "call_type").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
        F.sum("data_volume_mb").alias("total_data_mb"),
        customers.alias("distinct_customers"),
    )


def regional_revenue_monthly(t: Tables) -> DataFrame:
    return billed(t).groupBy("billing_period", "region", "customer_segment").agg(
        F.count_distinct("customer_id").alias("billed_customers"),
        F.sum("total_amount").alias("total_billed"),
        F.sum("paid_amount").alias("total_collected"),
    )


def tower_status(t: Tables) -> DataFrame:
    return t["dim_tower"].select("tower_id", "region", "capacity_mbps", "tower_status")


def daily_run_stats(runs: DataFrame) -> DataFrame:
    def runs_with(status: str) -> F.Column:
        return F.sum(F.when(F.col("status") == status, 1).otherwise(0))

    return (
        runs.groupBy("run_date", "job_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            runs_with("SUCCESS").alias("successful_runs"),
            runs_with("FAILED").alias("failed_runs"),
            runs_with("WARNING").alias("warning_runs"),
            *[F.sum(f"rows_{c}").alias(f"total_rows_{c}") for c in ("read", "inserted", "updated", "rejected")],
            F.round(F.avg("duration_seconds"), 1).alias("avg_duration_seconds"),
            F.max("duration_seconds").alias("max_duration_seconds"),
        )
        .orderBy(F.desc("run_date"), "job_name")
    )


def latest_run_status(runs: DataFrame) -> DataFrame:
    names = ("job_name", "status", "start_time", "end_time", "duration_seconds")
    rows = runs.select(*names, "rows_read", "rows_inserted", "rows_updated", "rows_rejected", "run_id")
    return latest_by_key(rows, ["job_name"], newest_first("start_time", "run_id")).drop("run_id")


def stats_of_days(days: DataFrame) -> DataFrame:
    """`daily_run_stats` from stored day rows; rows of one job and day, from several logs, add up."""
    seconds, timed = F.sum("total_duration_seconds"), F.sum("timed_runs")
    added = [c for c in DAY_TOTALS if c not in ("total_rows_deleted", "timed_runs", "total_duration_seconds")]
    return (
        days.groupBy("run_date", "job_name")
        .agg(
            *[F.sum(c).alias(c) for c in added],
            F.round(seconds / F.nullif(timed, F.lit(0)), 1).alias("avg_duration_seconds"),
            F.max("max_duration_seconds").alias("max_duration_seconds"),
        )
        .orderBy(F.desc("run_date"), "job_name")
    )


def open_errors(errors: DataFrame, runs: DataFrame) -> DataFrame:
    """Unresolved errors with how their run stands, newest first."""
    status = runs.select("run_id", F.col("status").alias("run_status"))
    names = ("error_id", "run_id", "job_name", "error_time", "error_type", "severity", "error_message")
    return (
        errors.where(~F.col("is_resolved"))
        .select(*names)
        .join(status, "run_id", "left")
        .select(*names, "run_status")
        .orderBy(F.desc("error_time"), F.desc("error_id"))
    )


def newest_open_errors(errors: DataFrame, runs: DataFrame, limit: int = 20) -> DataFrame:
    """The few on top of the list. They are picked first, so only they are joined."""
    top = errors.where(~F.col("is_resolved")).orderBy(F.desc("error_time"), F.desc("error_id")).limit(limit)
    return open_errors(top, runs.join(top.select("run_id").distinct(), "run_id", "left_semi"))


def validation_summary_today(summary: DataFrame, as_of: dt.date) -> DataFrame:
    """All of the day's runs together; a rule that ran twice counts its records twice."""
    checked, failed = F.sum("records_checked"), F.sum("records_failed")
    return (
        summary.where(F.to_date("checked_at") == F.lit(as_of))
        .groupBy("feed_name", "table_name", "rule_type", "column_name")
        .agg(
            checked.alias("records_checked"),
            failed.alias("records_failed"),
            percent(failed, checked).alias("pct_failed"),
            F.max("checked_at").alias("last_checked_at"),
        )
        .orderBy(F.desc("records_failed"))
    )


def open_validation_errors(errors: DataFrame) -> DataFrame:
    """Newest first. All errors of a run share their time, so the sort goes on by record:
    its ranges can then split what is one time value."""
    names = [c for c in errors.columns if c not in ("job_name", "raw_record", "is_resolved", "resolved_at", "resolved_by")]
    order = (F.desc("logged_at"), "record_key", "source_file_name", "column_name", "failed_value")
    return errors.where(~F.col("is_resolved")).select(*names).orderBy(*order)


def count_mismatches(counts: DataFrame) -> DataFrame:
    return (
        counts.where("check_status = 'MISMATCH'")
        .select(
            "feed_name",
            "table_name",
            "source_file_name",
            "source_row_count",
            "target_row_count",
            "row_count_variance",
            "checked_at",
        )
        .orderBy(F.desc("checked_at"), "source_file_name")
    )


def daily_summary(runs: DataFrame, as_of: dt.date) -> DataFrame:
    """The day's run statistics."""
    return daily_run_stats(runs.where(F.col("run_date") == F.lit(as_of)))
