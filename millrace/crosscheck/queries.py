"""Every operator as a query over the whole given tables: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from millrace.crosscheck import inputs
from millrace.crosscheck.inputs import CHECKED_FEEDS, FIRST_LOAD, IDLE_CHECK, SECOND_LOAD, stored
from millrace.feeds import FEEDS, Feed
from millrace.functions import masks
from millrace.operators import quality, runlog
from millrace.operators.changes import appended_rows, snapshot_diff
from millrace.operators.curate import append_fact, merge_target
from millrace.operators.governance import ROLE_REGIONS, secure, sensitive_inventory
from millrace.operators.history import scd2_apply
from millrace.operators.merge import SMALL_ROWS, changes_of, insert_absent, merge_counts, state
from millrace.operators.staging import merge_stage, stage_rows, unusable
from millrace.operators.surrogate import assign_keys
from millrace.plans import layers, reports
from millrace.session import scratch_dir
from millrace.sources import files
from millrace.sources.tables import Lake
from millrace.streaming.jobs import stream_raw, stream_to_target

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def plain(df: DataFrame, *drop: str) -> DataFrame:
    """Types any client reads alike: numbers as double or bigint, dates and times as text."""
    columns: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in drop:
            continue
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double" if f.dataType.scale else "bigint").alias(f.name)
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd").alias(f.name)
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        columns.append(c)
    return df.select(*columns)


def stamped(rows: DataFrame, at: dt.datetime) -> DataFrame:
    return rows.withColumn("updated_at", F.lit(at).cast("timestamp_ntz"))


def layer(kept: bool, spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer table, stored; or if not `kept`, for what is itself stored and reads it once, as a step of that.

    Steps on one key then follow each other where its rows lie, without being written, read and shuffled again.
    """
    return stored(spark, folder, name, build) if kept else build()


def first_state(spark: SparkSession, folder: str, feed: Feed, kept: bool = True) -> DataFrame:
    """The STAGING table as load 1 left it."""
    return layer(
        kept,
        spark,
        folder,
        f"staging/{feed.name}",
        lambda: stamped(stage_rows(inputs.raw_rows(spark, folder, feed, loads=1), feed), FIRST_LOAD),
    )


def second_merge(spark: SparkSession, folder: str, feed: Feed, small: bool = False, kept: bool = True) -> DataFrame:
    """The merge of all RAW into STAGING after load 2."""
    rows = stage_rows(inputs.raw_rows(spark, folder, feed), feed)
    return merge_stage(first_state(spark, folder, feed, kept), rows, feed, SECOND_LOAD, small=small)


def merged_state(spark: SparkSession, folder: str, feed: Feed, kept: bool = True) -> DataFrame:
    """The STAGING table as load 2 left it, with `_op`."""
    return layer(kept, spark, folder, f"merged/{feed.name}", lambda: second_merge(spark, folder, feed, kept=kept))


def second_changes(spark: SparkSession, folder: str, feed: Feed, kept: bool = True) -> DataFrame:
    return changes_of(merged_state(spark, folder, feed, kept))


def bare_schema(feed: Feed) -> str:
    """The target's columns without the surrogate key."""
    return feed.target_schema.removeprefix(f"{feed.target.surrogate} bigint, ")


def first_target(spark: SparkSession, folder: str, feed: Feed, kept: bool = True) -> DataFrame:
    """A type-1 dimension or keyed fact after the first batch."""

    def build() -> DataFrame:
        changes = layers.as_inserts(first_state(spark, folder, feed, kept))
        return state(merge_target(spark.createDataFrame([], bare_schema(feed)), changes, feed, FIRST_LOAD))

    return layer(kept, spark, folder, f"first/{feed.target.table}", build)


def second_target(spark: SparkSession, folder: str, feed: Feed, small: bool = False, kept: bool = True) -> DataFrame:
    """The same after both, with `_op`."""
    changes = second_changes(spark, folder, feed, kept)
    return merge_target(first_target(spark, folder, feed, kept), changes, feed, SECOND_LOAD, small=small)


def first_dimension(spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS["customers"]

    def build() -> DataFrame:
        changes = layers.as_inserts(first_state(spark, folder, feed))
        return scd2_apply(spark.createDataFrame([], bare_schema(feed)), changes, feed.key, feed.columns, FIRST_LOAD)

    return stored(spark, folder, "first/dim_customer", build)


def second_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The customer dimension after both batches, without surrogate keys."""
    feed = FEEDS["customers"]
    changes = second_changes(spark, folder, feed)
    return scd2_apply(first_dimension(spark, folder), changes, feed.key, feed.columns, SECOND_LOAD)


def usage_fact(spark: SparkSession, folder: str, kept: bool = True) -> DataFrame:
    """The usage fact: what each batch appended."""
    feed = FEEDS["cdr"]
    first = append_fact(layers.as_inserts(first_state(spark, folder, feed, kept)), feed, FIRST_LOAD)
    return first.unionByName(append_fact(second_changes(spark, folder, feed, kept), feed, SECOND_LOAD))


def curated(spark: SparkSession, folder: str, *tables: str) -> dict[str, DataFrame]:
    """Curated tables after both batches, all the reports read or just those named."""
    builds = {
        "dim_customer": lambda: second_dimension(spark, folder),
        "fact_cdr_usage": lambda: usage_fact(spark, folder, kept=False),
        "fact_billing": lambda: state(second_target(spark, folder, FEEDS["billing"], kept=False)),
        "fact_payments": lambda: state(second_target(spark, folder, FEEDS["payments"], kept=False)),
        "dim_tower": lambda: state(second_target(spark, folder, FEEDS["towers"])),
    }
    return {name: stored(spark, folder, f"curated/{name}", builds[name]) for name in tables or builds}


# -- staging, merges, change capture, targets ------------------------------------------


def _stage(name: str, spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS[name]
    return plain(stage_rows(inputs.raw_rows(spark, folder, feed), feed))


def _merge(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain(second_merge(spark, folder, FEEDS[name]))


def _measured_merge(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """The same, with the source counted first: it is broadcast if it is small, else it is not."""
    feed = FEEDS[name]
    small = inputs.raw_rows(spark, folder, feed).count() <= SMALL_ROWS
    return plain(second_merge(spark, folder, feed, small))


def _target(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain(second_target(spark, folder, FEEDS[name]))


for _name in FEEDS:
    QUERIES[f"stg_{_name}"] = partial(_stage, _name)
    if not FEEDS[_name].insert_only:
        QUERIES[f"stg_{_name}_merge"] = partial(_merge, _name)
    if FEEDS[_name].target.kind == "upsert":
        QUERIES[FEEDS[_name].target.table] = partial(_target, _name)

QUERIES["stg_cdr_insert_absent"] = partial(_merge, "cdr")
QUERIES["stg_cdr_insert_absent_small"] = partial(_measured_merge, "cdr")
QUERIES["stg_customers_merge_small"] = partial(_measured_merge, "customers")


@query("stg_cdr_insert_absent_deduped")
def _(spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS["cdr"]
    rows = stage_rows(inputs.raw_rows(spark, folder, feed), feed)
    return plain(insert_absent(first_state(spark, folder, feed), rows, [feed.key], dedupe=True))


@query("merge_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        merge_counts(second_merge(spark, folder, feed)).select(F.lit(feed.name).alias("feed_name"), "*")
        for feed in FEEDS.values()
        if not feed.insert_only
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _diff(name: str, spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS[name]
    after = state(second_merge(spark, folder, feed))
    return plain(snapshot_diff(first_state(spark, folder, feed), after, [feed.key]))


for _name in FEEDS:
    if not FEEDS[_name].insert_only:
        QUERIES[f"cdc_{_name}"] = partial(_diff, _name)


@query("cdc_cdr_appended")
def _(spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS["cdr"]
    before = first_state(spark, folder, feed)
    after = before.unionByName(state(merged_state(spark, folder, feed)))
    return plain(appended_rows(before, after, [feed.key]))


@query("dim_customer_scd2")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(second_dimension(spark, folder))


@query("fact_cdr_usage")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(usage_fact(spark, folder))


@query("surrogate_keys")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice keys numbered in key order, after a highest key of 1000."""
    rows = merged_state(spark, folder, FEEDS["billing"]).select("invoice_id", "total_amount")
    return plain(assign_keys(rows, "invoice_sk", 1000, "invoice_id"))


# -- reports ---------------------------------------------------------------------------

INVOICED = ("dim_customer", "fact_billing", "fact_payments")


def _report(report: Callable, tables: tuple[str, ...], role: str | None, spark: SparkSession, folder: str) -> DataFrame:
    """A report over the stored curated tables, as seen by a role if one is given."""
    given = curated(spark, folder, *tables)
    return plain(report(given if role is None else secure(given, role)))


for _key, _fn, _tables, _role in (
    ("customer_current", reports.customer_current, ("dim_customer",), None),
    ("monthly_summary", reports.customer_monthly_summary, (*INVOICED, "fact_cdr_usage"), None),
    ("usage_daily", reports.regional_usage_daily, ("fact_cdr_usage",), None),
    ("revenue_monthly", reports.regional_revenue_monthly, INVOICED, None),
    ("tower_status", reports.tower_status, ("dim_tower",), None),
    ("monthly_summary_north", reports.customer_monthly_summary, (*INVOICED, "fact_cdr_usage"), "R_ANALYST_NORTH"),
    ("usage_daily_south", reports.regional_usage_daily, ("fact_cdr_usage",), "R_ANALYST_SOUTH"),
    ("tower_status_unmapped_role", reports.tower_status, ("dim_tower",), "R_UNKNOWN"),
):
    QUERIES[_key] = partial(_report, _fn, _tables, _role)


@query("revenue_monthly_north_mapped")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The row filter with its map held as a table."""
    role_map = spark.createDataFrame([*ROLE_REGIONS, *ROLE_REGIONS], "role_name string, region string")
    given = secure(curated(spark, folder, *INVOICED), "R_ANALYST_NORTH", role_map)
    return plain(reports.regional_revenue_monthly(given))


def _masked(table: str, role: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain(secure(curated(spark, folder, table), role)[table])


for _role in ("R_COMPLIANCE_OFFICER", "R_ANALYST_GLOBAL", "R_ANALYST_NORTH", "R_DATA_ENGINEER"):
    QUERIES[f"masked_customers_{_role[2:].lower()}"] = partial(_masked, "dim_customer", _role)
QUERIES["masked_payments"] = partial(_masked, "fact_payments", "R_ANALYST_GLOBAL")
QUERIES["masked_cdr"] = partial(_masked, "fact_cdr_usage", "R_ANALYST_SOUTH")


@query("rounded_billing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage_rows(inputs.raw_rows(spark, folder, FEEDS["billing"]), FEEDS["billing"])
    return plain(rows.select("invoice_id", masks.round_currency("total_amount", "R_ANALYST_GLOBAL").alias("total_amount")))


@query("pii_inventory")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return sensitive_inventory(curated(spark, folder, "dim_customer", "fact_payments", "fact_cdr_usage", "fact_billing"))


# -- data quality ----------------------------------------------------------------------

CHECKED_AT = dt.datetime(2024, 3, 2, 8, 0, 0)


def context(feed: Feed, run_id: int = 7, at: dt.datetime = CHECKED_AT) -> quality.CheckContext:
    return quality.CheckContext(run_id, feed.validate_job, feed.name, feed.raw_table, at)


def _summary(name: str, spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS[name]
    return plain(quality.rule_summary(inputs.raw_rows(spark, folder, feed, once=True), feed.rules, context(feed)))


def _errors(name: str, spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS[name]
    errors = quality.rule_errors(inputs.raw_rows(spark, folder, feed, once=True), feed.rules, feed.key, context(feed))
    return plain(errors, "raw_record", "resolved_at", "resolved_by")


for _name in FEEDS:
    QUERIES[f"dq_summary_{_name}"] = partial(_summary, _name)
    QUERIES[f"dq_errors_{_name}"] = partial(_errors, _name)


@query("dq_errors_since")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Only rows loaded after the first load are checked."""
    feed = FEEDS["billing"]
    rows = quality.since(inputs.raw_rows(spark, folder, feed, once=True), FIRST_LOAD)
    return plain(quality.rule_summary(rows, feed.rules, context(feed)))


@query("dq_staging_checks")
def _(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name in ("customers", "cdr"):
        feed = FEEDS[name]
        check, broken, sql = unusable(feed)
        ctx = quality.CheckContext(7, feed.stage_job, feed.name, feed.raw_table, CHECKED_AT)
        rows = quality.check_rows(inputs.raw_rows(spark, folder, feed, once=True), {check: (broken, sql)}, ctx)
        out = rows if out is None else out.unionByName(rows)
    return plain(out, "check_sql")


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """All feeds: rows landed against lines sent; the file customers_1_3.csv is gone."""
    out = None
    for feed in FEEDS.values():
        sent = quality.file_counts(inputs.feed_lines(spark, folder, feed), "source_row_count")
        sent = sent.where("source_file_name <> 'customers_1_3.csv'")
        rows = quality.reconcile(inputs.raw_rows(spark, folder, feed, once=True), sent, context(feed))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("dq_reconcile")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(reconciliation(spark, folder))


@query("dq_mismatches")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(reports.count_mismatches(reconciliation(spark, folder)))


@query("dq_reconcile_summary")
def _(spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS["customers"]
    recon = reconciliation(spark, folder).where(F.col("feed_name") == feed.name)
    return plain(quality.reconcile_summary(recon, context(feed)))


@query("dq_summary_today")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A check the day before and two on the day; the two add up."""
    out = None
    for feed in FEEDS.values():
        for run_id, at, loads in ((1, CHECKED_AT - dt.timedelta(days=1), 1), (2, CHECKED_AT, 1), (3, CHECKED_AT.replace(hour=9), 2)):
            rows = quality.rule_summary(inputs.raw_rows(spark, folder, feed, loads), feed.rules, context(feed, run_id, at))
            out = rows if out is None else out.unionByName(rows)
    return plain(reports.validation_summary_today(out, CHECKED_AT.date()))


@query("dq_open_errors")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of all feeds with those of region taken as resolved."""
    errors = None
    for feed in FEEDS.values():
        found = quality.rule_errors(inputs.raw_rows(spark, folder, feed, once=True), feed.rules, feed.key, context(feed))
        errors = found if errors is None else errors.unionByName(found)
    errors = errors.withColumn("is_resolved", F.col("column_name") == "region")
    return plain(reports.open_validation_errors(errors))


# -- run log ---------------------------------------------------------------------------


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """A START and mostly an END or FAIL event per order, the order standing for a run."""
    runs = inputs.run_rows(spark, folder)
    nothing = F.lit(None).cast("bigint")
    names = ("event", "event_ts", *runlog.ROW_COUNTERS, "triggered_by", "comments")

    def event(kind: Column, at: str, rows: list[Column], by: Column, comment: Column) -> Column:
        return F.struct(*[c.alias(n) for c, n in zip((kind, F.col(at), *rows, by, comment), names, strict=True)])

    ended = F.col("outcome") == "END"
    counts = [F.when(ended, F.col(c)) for c in ("rows_read", "rows_inserted", "rows_updated")]
    start = event(F.lit("START"), "started", [nothing] * 5, F.lit("TASK"), F.lit(None).cast("string"))
    close = event(
        F.col("outcome"), "ended", [*counts, F.when(ended, F.lit(0)), F.when(ended, F.col("rows_rejected"))],
        F.lit(None).cast("string"), F.concat(F.lit("run "), F.col("run_id").cast("string"), F.lit(" closed")),
    )
    both = F.array_compact(F.array(start, F.when(F.col("outcome") != "NONE", close)))
    return runs.select("run_id", "job_name", F.to_date("started").alias("run_date"), F.inline(both)).select(
        "*", F.lit("WH_TRANSFORM").alias("warehouse_used"), F.lit(None).cast("string").alias("query_id")
    )


def run_errors(spark: SparkSession, folder: str) -> DataFrame:
    """An error per failed run."""
    failed = inputs.run_rows(spark, folder).where("outcome = 'FAIL'")
    return failed.select(
        F.col("run_id").alias("error_id"),
        "run_id",
        "job_name",
        F.col("ended").alias("error_time"),
        F.lit("SQL_ERROR").alias("error_type"),
        F.concat(F.lit("failed after "), F.col("rows_read").cast("string"), F.lit(" rows")).alias("error_message"),
        F.lit("CRITICAL").alias("severity"),
        F.col("resolved").alias("is_resolved"),
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events as the log holds them, by month of the run's start."""
    return stored(
        spark, folder, "audit/events", lambda: run_events(spark, folder).withColumn("run_month", layers.day_part()), ["run_month"]
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.run_log(event_log(spark, folder))


def run_states(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.run_states(event_log(spark, folder))


@query("run_log")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(run_log(spark, folder), "warehouse_used", "query_id")


@query("daily_run_stats")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(reports.daily_run_stats(run_states(spark, folder)))


@query("daily_summary")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The statistics of the last day with runs."""
    events = event_log(spark, folder)
    last = events.agg(F.max("run_date")).first()[0]
    month = events.where(F.col("run_month") == f"{last:%Y-%m}")
    return plain(reports.daily_summary(runlog.run_states(month), last))


@query("latest_run_status")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(reports.latest_run_status(run_states(spark, folder)))


@query("open_errors")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(reports.open_errors(run_errors(spark, folder), run_states(spark, folder)))


@query("newest_open_errors")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return plain(reports.newest_open_errors(run_errors(spark, folder), run_states(spark, folder)))


@query("job_registry")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The registry after the runs, with how often each job ran."""
    events = run_events(spark, folder)
    jobs = runlog.register_jobs(runlog.job_rows(spark, FIRST_LOAD), events, SECOND_LOAD)
    ran = events.where("event = 'START'").groupBy("job_name").agg(F.count(F.lit(1)).alias("runs"))
    return plain(jobs.join(ran, "job_name", "left"))


# -- files and streams -----------------------------------------------------------------


def scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def sent_files(
    spark: SparkSession, folder: str, feed: Feed, load: dt.datetime | None = None, target: str | None = None
) -> str:
    """The lines of a feed, or of one load of it, as delimited files, one by each task that reads them."""
    target = target or f"{scratch(spark, 'landing')}/{feed.name}"
    lines = inputs.feed_lines(spark, folder, feed)
    if load is not None:
        lines = lines.where(F.col("_load_ts") == F.lit(load).cast("timestamp_ntz"))
    lines.select(*feed.columns).write.mode("append").option("header", "true").option("escape", '"').csv(target)
    return target


@query("raw_load_customers")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited files read back: null tokens out, over-long rows refused."""
    feed = FEEDS["customers"]
    rows = files.read_feed(spark, feed, sent_files(spark, folder, feed), SECOND_LOAD)
    good, _ = files.split_rejects(rows, feed)
    return plain(good, "source_file_name")


@query("raw_load_report")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed, loaded and refused rows of all feeds, summed over their files."""
    out = None
    for feed in FEEDS.values():
        rows = files.read_feed(spark, feed, sent_files(spark, folder, feed), SECOND_LOAD)
        report = files.load_report(files.flag_rejects(rows, feed), feed, SECOND_LOAD)
        out = report if out is None else out.unionByName(report)
    return files.load_totals(out).drop("files")


@query("raw_load_json_plans")
def _(spark: SparkSession, folder: str) -> DataFrame:
    feed = FEEDS["plans"]
    target = scratch(spark, "landing-json")
    inputs.feed_lines(spark, folder, feed).select(*feed.columns).write.json(target)
    rows = files.read_json_feed(spark, feed, target, SECOND_LOAD, array=False)
    good, _ = files.split_rejects(rows, feed)
    return plain(good, "source_file_name")


@query("stream_cdr_fact")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Files streamed to RAW, STAGING and the usage fact; one row per key."""
    feed = FEEDS["cdr"]
    lake = Lake(spark, scratch(spark, "lake"))
    landing = sent_files(spark, folder, feed)
    stream_to_target(lake, feed, landing, scratch(spark, "stream")).awaitTermination()
    return plain(layers.read_target(lake, feed), "loaded_at")


@query("stream_customers_dim")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads streamed one after the other to the dimension: current and closed versions."""
    feed = FEEDS["customers"]
    lake, checkpoint = Lake(spark, scratch(spark, "lake")), scratch(spark, "stream")
    landing = None
    for load in (FIRST_LOAD, SECOND_LOAD):
        landing = sent_files(spark, folder, feed, load, landing)
        stream_to_target(lake, feed, landing, checkpoint).awaitTermination()
    return plain(layers.read_target(lake, feed), "customer_sk", "eff_start_ts", "eff_end_ts")


@query("stream_raw_towers")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Towers streamed to RAW beside another feed that streams into the same tables' folder."""
    lake = Lake(spark, scratch(spark, "lake"))
    for feed in (FEEDS["plans"], FEEDS["towers"]):
        stream_raw(lake, feed, sent_files(spark, folder, feed), scratch(spark, "stream")).awaitTermination()
    return plain(layers.read_raw(lake, FEEDS["towers"]).select(*FEEDS["towers"].columns))


@query("layers_dim_customer")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """All layers run on the files of two loads, from landing to the dimension with its surrogate keys."""
    feed = FEEDS["customers"]
    lake = Lake(spark, scratch(spark, "lake"))
    target = None
    for load in (FIRST_LOAD, SECOND_LOAD):
        target = sent_files(spark, folder, feed, load, target)
        layers.run_raw(lake, target.rsplit("/", 1)[0], [feed], load)
        layers.run_staging(lake, [feed], load)
        layers.run_curated(lake, load, feeds=[feed.name])
    return plain(layers.read_target(lake, feed))


@query("layers_dim_device")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """All layers run on two loads, to the type-1 dimension with its surrogate keys; only touched buckets are written again."""
    feed = FEEDS["devices"]
    lake = Lake(spark, scratch(spark, "lake"))
    target = None
    for load in (FIRST_LOAD, SECOND_LOAD):
        target = sent_files(spark, folder, feed, load, target)
        layers.run_raw(lake, target.rsplit("/", 1)[0], [feed], load)
        layers.run_staging(lake, [feed], load)
        layers.run_curated(lake, load, feeds=[feed.name])
    return plain(layers.read_target(lake, feed), feed.target.stamp)


_CHECKED: dict[tuple[str, str], str] = {}
_CHECKING = threading.RLock()


def checked_lake(spark: SparkSession, folder: str) -> Lake:
    """Two loads of two feeds, each checked as it came, and a check when nothing was new. Made once per application."""
    key = (spark.sparkContext.applicationId, folder)
    with _CHECKING:
        if key not in _CHECKED:
            root, landing = scratch(spark, "lake"), scratch(spark, "landing")
            lake, feeds = Lake(spark, root), [FEEDS[name] for name in CHECKED_FEEDS]
            for load in (FIRST_LOAD, SECOND_LOAD):
                for feed in feeds:
                    sent_files(spark, folder, feed, load, f"{landing}/{feed.name}")
                layers.run_raw(lake, landing, feeds, load)
                layers.run_validate(lake, landing, feeds, load)
            layers.run_validate(lake, landing, feeds, IDLE_CHECK)
            _CHECKED[key] = root
    return Lake(spark, _CHECKED[key])


@query("layers_validation_errors")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Stored errors: each found once, in the check after its load."""
    errors = layers.validation_errors(checked_lake(spark, folder))
    record = F.parse_json("raw_record")
    fields = [F.try_variant_get(record, f"$.{c}", "string").alias(f"raw_{c}") for c in ("region", "invoice_status")]
    return plain(errors.select("*", *fields), "run_id", "raw_record", "source_file_name", "is_resolved", "resolved_at", "resolved_by")


@query("layers_validation_summary")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Stored summaries of three checks; the last one had nothing to read."""
    return plain(layers.validation_summary(checked_lake(spark, folder)), "run_id")


@query("layers_file_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Stored counts of real files against the rows landed from them, summed over the files of each check."""
    counts = layers.count_log(checked_lake(spark, folder)).groupBy("feed_name", "checked_at")
    return plain(
        counts.agg(
            F.sum("source_row_count").alias("source_rows"),
            F.sum("target_row_count").alias("target_rows"),
            F.count_if(F.col("row_count_variance") > 0).alias("files_with_more"),
        )
    )


_LOGGED: dict[tuple[str, str], str] = {}


def logged_lake(spark: SparkSession, folder: str) -> Lake:
    """All runs' START events logged and folded, then what ended them, with the registries loaded before, between and after."""
    key = (spark.sparkContext.applicationId, folder)
    with _CHECKING:
        if key not in _LOGGED:
            lake, events = Lake(spark, scratch(spark, "lake")), run_events(spark, folder)
            layers.load_registries(lake, [], FIRST_LOAD)
            ran = [r.job_name for r in events.select("job_name").distinct().collect()]  # job names only
            for at, step, part in ((FIRST_LOAD, "started", "event = 'START'"), (SECOND_LOAD, "ended", "event <> 'START'")):
                batch = lake.begin(step)
                layers.log_events(lake, batch, events.where(part), rebalance=True)
                lake.commit(batch, at)
                layers.fold_runs(lake, at)
                layers.load_registries(lake, ran, SECOND_LOAD)
            _LOGGED[key] = lake.root
    return Lake(spark, _LOGGED[key])


@query("layers_run_days")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The statistics by day, added up from the stored day rows of two folds."""
    return plain(reports.stats_of_days(layers.run_days(logged_lake(spark, folder))))


@query("layers_latest_runs")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Each job's newest run, from the newest run of each day."""
    return plain(reports.latest_run_status(layers.run_days(logged_lake(spark, folder))))


@query("layers_job_registry")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The stored registry after it was loaded three times, with how often each job ran."""
    lake = logged_lake(spark, folder)
    ran = layers.run_days(lake).groupBy("job_name").agg(F.sum("total_runs").alias("runs"))
    return plain(layers.job_registry(lake).join(ran, "job_name", "left"))


THIRD_LOAD = SECOND_LOAD + dt.timedelta(hours=2)


@query("layers_net_changes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """What one curated run has to carry over after two staged batches and a removal.

    The second load changes most towers, a third one those whose id ends in 5 again, and those whose id ends in 7 are removed:
    known ones are a DELETE alone, ones that the second load brought are nothing.
    """
    feed = FEEDS["towers"]
    lake = Lake(spark, scratch(spark, "lake"))
    target = sent_files(spark, folder, feed, FIRST_LOAD)
    landing = target.rsplit("/", 1)[0]
    layers.run_raw(lake, landing, [feed], FIRST_LOAD)
    layers.run_staging(lake, [feed], FIRST_LOAD)
    layers.run_curated(lake, FIRST_LOAD, feeds=[feed.name])
    sent_files(spark, folder, feed, SECOND_LOAD, target)
    layers.run_raw(lake, landing, [feed], SECOND_LOAD)
    layers.run_staging(lake, [feed], SECOND_LOAD)
    again = layers.read_stage(lake, feed).where("tower_id LIKE '%5'").withColumn("capacity_mbps", F.lit("777"))
    again.select(*feed.columns).write.mode("append").option("header", "true").option("escape", '"').csv(target)
    layers.run_raw(lake, landing, [feed], THIRD_LOAD)
    layers.run_staging(lake, [feed], THIRD_LOAD)
    gone = layers.read_stage(lake, feed).where("tower_id LIKE '%7'")
    layers.remove_keys(lake, feed, gone, THIRD_LOAD)
    return plain(layers.pending_changes(lake, feed), "updated_at", "_changed_at")
