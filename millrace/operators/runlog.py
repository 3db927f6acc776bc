"""The run log as appended events, folded to the present state when read.

An event carries the day its run started, so all events of a run lie in one month's partition and a day is folded by itself.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.casts import seconds_between
from millrace.operators.merge import insert_absent
from millrace.session import few_rows

ROW_COUNTERS = ("rows_read", "rows_inserted", "rows_updated", "rows_deleted", "rows_rejected")

EVENT_SCHEMA = (
    "run_id bigint, job_name string, run_date date, event string, event_ts timestamp_ntz, "
    + ", ".join(f"{c} bigint" for c in ROW_COUNTERS)
    + ", triggered_by string, warehouse_used string, query_id string, comments string"
)
ERROR_SCHEMA = (
    "error_id bigint, run_id bigint, job_name string, error_time timestamp_ntz, error_type string, "
    "sql_state string, error_message string, error_context string, severity string, "
    "is_resolved boolean, resolved_at timestamp_ntz, resolved_by string"
)
STATE_COLUMNS = ("status", "start_time", "end_time", "duration_seconds", *ROW_COUNTERS)
DAY_TOTALS = (
    "total_runs", "successful_runs", "failed_runs", "warning_runs",
    *[f"total_{c}" for c in ROW_COUNTERS], "timed_runs", "total_duration_seconds",
)
DAY_SCHEMA = (
    "run_date date, job_name string, "
    + ", ".join(f"{c} bigint" for c in (*DAY_TOTALS, "max_duration_seconds"))
    + ", run_id bigint, status string, start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds bigint, "
    + ", ".join(f"{c} bigint" for c in ROW_COUNTERS)
)
JOB_SCHEMA = (
    "job_name string, layer string, source_object string, target_object string, schedule_cron string, "
    "is_active boolean, created_at timestamp_ntz"
)

# Job, layer, source, target, schedule.
JOBS = (
    ("RAW_TO_STAGING_CUSTOMERS", "STAGE_LOAD", "RAW.RAW_CUSTOMERS", "STAGING.STG_CUSTOMERS", "0 6 * * *"),
    ("RAW_TO_STAGING_PLANS", "STAGE_LOAD", "RAW.RAW_PLANS", "STAGING.STG_PLANS", "0 6 * * *"),
    ("RAW_TO_STAGING_DEVICES", "STAGE_LOAD", "RAW.RAW_DEVICES", "STAGING.STG_DEVICES", "0 6 * * *"),
    ("RAW_TO_STAGING_CDR", "STAGE_LOAD", "RAW.RAW_CDR", "STAGING.STG_CDR", "0 * * * *"),
    ("RAW_TO_STAGING_BILLING", "STAGE_LOAD", "RAW.RAW_BILLING", "STAGING.STG_BILLING", "0 7 * * *"),
    ("RAW_TO_STAGING_PAYMENTS", "STAGE_LOAD", "RAW.RAW_PAYMENTS", "STAGING.STG_PAYMENTS", "0 7 * * *"),
    ("RAW_TO_STAGING_TOWERS", "STAGE_LOAD", "RAW.RAW_TOWERS", "STAGING.STG_TOWERS", "0 6 * * *"),
    ("RAW_TO_STAGING_SUPPORT_TICKETS", "STAGE_LOAD", "RAW.RAW_SUPPORT_TICKETS", "STAGING.STG_SUPPORT_TICKETS", "0 6 * * *"),
    ("STAGING_TO_CURATED_DIM_CUSTOMER", "CURATED_MERGE", "STAGING.STRM_CUSTOMERS", "CURATED.DIM_CUSTOMER", "0 8 * * *"),
    ("STAGING_TO_CURATED_DIM_PLAN", "CURATED_MERGE", "STAGING.STRM_PLANS", "CURATED.DIM_PLAN", "0 8 * * *"),
    ("STAGING_TO_CURATED_DIM_DEVICE", "CURATED_MERGE", "STAGING.STRM_DEVICES", "CURATED.DIM_DEVICE", "0 8 * * *"),
    ("STAGING_TO_CURATED_DIM_TOWER", "CURATED_MERGE", "STAGING.STRM_TOWERS", "CURATED.DIM_TOWER", "0 8 * * *"),
    ("STAGING_TO_CURATED_FACT_CDR", "CURATED_MERGE", "STAGING.STRM_CDR", "CURATED.FACT_CDR_USAGE", "15 * * * *"),
    ("STAGING_TO_CURATED_FACT_BILLING", "CURATED_MERGE", "STAGING.STRM_BILLING", "CURATED.FACT_BILLING", "0 9 * * *"),
    ("STAGING_TO_CURATED_FACT_PAYMENTS", "CURATED_MERGE", "STAGING.STRM_PAYMENTS", "CURATED.FACT_PAYMENTS", "0 9 * * *"),
    ("STAGING_TO_CURATED_FACT_TICKETS", "CURATED_MERGE", "STAGING.STRM_SUPPORT_TICKETS", "CURATED.FACT_SUPPORT_TICKETS", "0 9 * * *"),
)


def job_rows(spark: SparkSession, created_at: dt.datetime) -> DataFrame:
    return few_rows(spark, [(*job, True, created_at) for job in JOBS], JOB_SCHEMA)


def register_jobs(registry: DataFrame, events: DataFrame, created_at: dt.datetime) -> DataFrame:
    """The registry plus an AD_HOC row for each job that ran without being in it."""
    return registry.unionByName(ad_hoc_jobs(registry, events, created_at))


def ad_hoc_jobs(registry: DataFrame, events: DataFrame, created_at: dt.datetime) -> DataFrame:
    """An AD_HOC row for each job that ran without being in the registry."""
    unknown = insert_absent(registry, events.select("job_name").distinct(), ["job_name"])
    return unknown.select(
        "job_name",
        F.lit("AD_HOC").alias("layer"),
        F.lit(None).cast("string").alias("source_object"),
        F.lit(None).cast("string").alias("target_object"),
        F.lit(None).cast("string").alias("schedule_cron"),
        F.lit(True).alias("is_active"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )


def start_event(run_id: int, job: str, at: dt.datetime, triggered_by: str) -> dict:
    return {**_event(run_id, job, "START", at, None), "triggered_by": triggered_by}


def end_event(
    run_id: int, job: str, at: dt.datetime, comments: str = "", day: dt.date | None = None, **rows: int
) -> dict:
    """Ends a run; it counts as WARNING when rows were rejected. `day` is that of its start, if it is another than `at`'s."""
    counters = {c: int(rows.get(c, 0)) for c in ROW_COUNTERS}
    return {**_event(run_id, job, "END", at, day), "comments": comments, **counters}


def fail_event(run_id: int, job: str, at: dt.datetime, message: str, day: dt.date | None = None) -> dict:
    return {**_event(run_id, job, "FAIL", at, day), "comments": message[:1000]}


def _event(run_id: int, job: str, event: str, at: dt.datetime, day: dt.date | None) -> dict:
    return {"run_id": run_id, "job_name": job, "run_date": day or at.date(), "event": event, "event_ts": at}


def error_row(
    error_id: int,
    run_id: int,
    job: str,
    at: dt.datetime,
    error_type: str,
    message: str,
    context: Mapping | None = None,
    severity: str = "CRITICAL",
    sql_state: str | None = None,
) -> dict:
    return {
        "error_id": error_id,
        "run_id": run_id,
        "job_name": job,
        "error_time": at,
        "error_type": error_type,
        "sql_state": sql_state,
        "error_message": message[:4000],
        "error_context": json.dumps(dict(context or {})),
        "severity": severity,
        "is_resolved": False,
    }


def numbered(errors: list[dict], after: int) -> list[dict]:
    """Error rows with ids after + 1, after + 2, ... by run, a run's in the order they were found."""
    return [{**row, "error_id": after + 1 + i} for i, row in enumerate(sorted(errors, key=lambda row: row["run_id"]))]


def rows_as_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    return few_rows(spark, [[row.get(n) for n in names] for row in rows], schema)


FOLD_EVENTS = 250_000  # events a task folds, at some 400 bytes for each of two hash tables


def run_states(events: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per run: RUNNING until it ends, then SUCCESS, WARNING or FAILED, without the texts of its events.

    A run's newest END or FAIL decides, at one time a FAIL; ENDs at one time count as one, with the larger of each counter.
    The state has columns of fixed width alone, so events are hashed and never sorted, and a filter on `run_date` reaches
    the events' scan. Hardly any two events fold into one, so they are dealt by run before they are hashed: a task that
    read a large file's events would hold them all. `rows`, if their number is known, says in how many parts.
    """
    run = ["run_date", "run_id", "job_name"]
    ended, failed = F.col("event") == "END", F.col("event") == "FAIL"
    parts = [] if rows is None else [-(-rows // FOLD_EVENTS) or 1]
    moments = events.repartition(*parts, *run).groupBy(*run, "event_ts").agg(
        F.max(F.col("event") == "START").alias("starts"),
        F.max(ended | failed).alias("closes"),
        F.max(failed).alias("fails"),
        *[F.max(F.when(ended, F.col(c))).alias(c) for c in ROW_COUNTERS],
    )
    closing = F.when(F.col("closes"), F.col("event_ts"))
    folded = moments.groupBy(*run).agg(
        F.min(F.when(F.col("starts"), F.col("event_ts"))).alias("start_time"),
        F.max(closing).alias("end_time"),
        F.max_by("fails", closing).alias("failed"),
        *[F.max_by(F.when(~F.col("fails"), F.col(c)), closing).alias(c) for c in ROW_COUNTERS],
    )
    counters = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ROW_COUNTERS]
    status = _status(F.col("end_time").isNull(), F.col("failed"), F.col("rows_rejected"))
    seconds = seconds_between("start_time", "end_time").cast("bigint").alias("duration_seconds")
    return folded.select(*run, status.alias("status"), "start_time", "end_time", seconds, *counters)


def _status(runs_on: Column, failed: Column, rejected: Column) -> Column:
    bad = F.coalesce(rejected, F.lit(0)) > 0
    return F.when(runs_on, "RUNNING").when(failed, "FAILED").when(bad, "WARNING").otherwise("SUCCESS")


def run_log(events: DataFrame) -> DataFrame:
    """One row per run, with what its events say in words.

    One aggregation by run; a run's newest END or FAIL decides, of ENDs at one time that with the larger counters and comment.
    """
    closing = F.col("event").isin("END", "FAIL")
    last = F.max(F.when(closing, F.struct("event_ts", "event", *ROW_COUNTERS, "comments")))
    started = F.min(F.when(F.col("event") == "START", F.struct("event_ts", "triggered_by", "warehouse_used", "query_id")))
    folded = events.groupBy("run_date", "run_id", "job_name").agg(started.alias("first"), last.alias("last"))
    status = _status(F.col("last.event").isNull(), F.col("last.event") == "FAIL", F.col("last.rows_rejected"))
    return folded.select(
        "run_id",
        "job_name",
        "run_date",
        F.col("first.event_ts").alias("start_time"),
        F.col("last.event_ts").alias("end_time"),
        status.alias("status"),
        *[F.coalesce(F.col(f"last.{c}"), F.lit(0)).cast("bigint").alias(c) for c in ROW_COUNTERS],
        seconds_between("first.event_ts", "last.event_ts").cast("bigint").alias("duration_seconds"),
        F.col("first.triggered_by").alias("triggered_by"),
        F.col("first.warehouse_used").alias("warehouse_used"),
        F.col("first.query_id").alias("query_id"),
        F.col("last.comments").alias("comments"),
    )


def day_rows(states: DataFrame) -> DataFrame:
    """One row per job and day: sums that can be added up further, and the day's newest run.

    The newest run is the largest by start and id. It is found in each task before the shuffle, so a job with very many runs a
    day is no large task, and the states are worked out once for it and the sums.
    """
    newest = ("start_time", "run_id", *[c for c in STATE_COLUMNS if c != "start_time"])

    def runs_with(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    days = states.groupBy("run_date", "job_name").agg(
        F.count(F.lit(1)).alias("total_runs"),
        runs_with("SUCCESS").alias("successful_runs"),
        runs_with("FAILED").alias("failed_runs"),
        runs_with("WARNING").alias("warning_runs"),
        *[F.sum(c).alias(f"total_{c}") for c in ROW_COUNTERS],
        F.count("duration_seconds").alias("timed_runs"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
        F.max("duration_seconds").alias("max_duration_seconds"),
        F.max(F.struct(*newest)).alias("_newest"),
    )
    return days.select("*", "_newest.*").select(*[f.name for f in StructType.fromDDL(DAY_SCHEMA)])
