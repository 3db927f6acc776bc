"""The layer jobs: raw, validate, staging, curated, and all of them in order.

Each layer runs on its own. A feed that fails is logged and does not stop the others.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import traceback
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.feeds import CURATED_ORDER, FEEDS, Feed, pick
from millrace.functions.casts import month_of
from millrace.operators import quality, runlog
from millrace.operators.curate import append_fact, merge_target, target_rows
from millrace.operators.governance import ROLE_REGIONS
from millrace.operators.history import end_versions, open_versions
from millrace.operators.changes import net_changes
from millrace.operators.merge import SMALL_ROWS, change_pairs, insert_absent, op_counters, upsert
from millrace.operators.staging import cast_feed, merge_stage, stage_rows, unusable
from millrace.operators.surrogate import assign_keys
from millrace.plans import reports
from millrace.session import few_rows
from millrace.sources import files
from millrace.sources.tables import Batch, Lake, Part

SUMMARY_SCHEMA = (
    "run_id bigint, job_name string, feed_name string, table_name string, rule_type string, column_name string, "
    "records_checked bigint, records_failed bigint, check_status string, checked_at timestamp_ntz"
)
VALIDATION_ERROR_SCHEMA = (
    "run_id bigint, job_name string, feed_name string, table_name string, rule_type string, column_name string, "
    "record_key string, failed_value string, error_reason string, source_file_name string, raw_record string, "
    "load_ts timestamp_ntz, logged_at timestamp_ntz, is_resolved boolean, resolved_at timestamp_ntz, resolved_by string"
)
COUNT_SCHEMA = (
    "run_id bigint, feed_name string, table_name string, source_file_name string, source_row_count bigint, "
    "target_row_count bigint, row_count_variance bigint, check_status string, checked_at timestamp_ntz"
)
DQ_SCHEMA = (
    "run_id bigint, job_name string, check_name string, table_name string, check_sql string, "
    "records_checked bigint, records_failed bigint, check_status string, checked_at timestamp_ntz"
)
RULE_SCHEMA = "feed_name string, table_name string, column_name string, rule_type string, rule_detail string"
REGION_SCHEMA = "role_name string, region string"
OUTCOME_SCHEMA = (
    "layer string, job_name string, status string, rows_read bigint, rows_inserted bigint, rows_updated bigint, "
    "rows_rejected bigint, message string"
)

EVENTS = "audit/events"
ERRORS = "audit/errors"
RUN_DAYS = "audit/run_days"
JOB_REGISTRY = "audit/jobs"
RULE_REGISTRY = "validation/rules"
REGION_REGISTRY = "governance/role_regions"
LOADS = "audit/loads"
DQ_CHECKS = "audit/dq_checks"
SUMMARY = "validation/summary"
VIOLATIONS = "validation/errors"
COUNTS = "validation/counts"
DIM_CURRENT = "curated/dim_customer_current"
DIM_HISTORY = "curated/dim_customer_history"


def raw_table(feed: Feed) -> str:
    return f"raw/{feed.name}"


def stage_table(feed: Feed) -> str:
    return f"staging/{feed.name}"


def change_table(feed: Feed) -> str:
    return f"changes/{feed.name}"


def target_table(feed: Feed) -> str:
    return f"curated/{feed.target.table}"


def read_raw(lake: Lake, feed: Feed, after: str | None = None, until: str | None = None) -> DataFrame:
    """Landed rows without the refused ones."""
    rows = lake.read(raw_table(feed), f"{feed.raw_schema}, _reject string", after, until=until)
    return rows.where(F.col("_reject").isNull()).drop("_reject")


def read_rejects(lake: Lake, feed: Feed) -> DataFrame:
    rows = lake.read(raw_table(feed), f"{feed.raw_schema}, _reject string")
    return rows.where(F.col("_reject").isNotNull())


def read_stage(lake: Lake, feed: Feed) -> DataFrame:
    return lake.read(stage_table(feed), feed.stage_schema)


def read_target(lake: Lake, feed: Feed) -> DataFrame:
    if feed.target.kind == "scd2":
        current = lake.read(DIM_CURRENT, feed.target_schema)
        return current.unionByName(lake.read(DIM_HISTORY, feed.target_schema))
    return lake.read(target_table(feed), feed.target_schema)


def curated_tables(lake: Lake) -> dict[str, DataFrame]:
    return {feed.target.table: read_target(lake, feed) for feed in FEEDS.values()}


# -- one feed, one batch ---------------------------------------------------------------


def land(lake: Lake, batch: Batch, feed: Feed, rows: DataFrame, batch_ts: dt.datetime) -> tuple[str, dict[str, int]]:
    """Write landing rows, refused ones flagged, parsing the files once.

    The per-file report is read back from three columns of the written part.
    """
    refused = F.count_if(F.col("_reject").isNotNull()).alias("rows_rejected")
    path, counts = lake.write(batch, raw_table(feed), files.flag_rejects(rows, feed), counters=[refused])
    written = lake.read_paths([path], "source_file_name string, _reject string, _line bigint")
    lake.write(batch, f"{LOADS}/{feed.name}", files.load_report(written, feed, batch_ts).coalesce(1))
    return path, counts


def stage(
    lake: Lake,
    batch: Batch,
    feed: Feed,
    raw: DataFrame,
    batch_ts: dt.datetime,
    small: bool = False,
    dedupe: bool = False,
) -> tuple[str, dict[str, int]]:
    """Merge landing rows into the staging table; returns the folder of the change set.

    The merged rows are stored with their `_op` and, if updated, as they were before, so the change set is a
    filtered read of what was just written, not a second run of the merge.
    """
    rows = stage_rows(raw, feed)
    if feed.insert_only:
        staged = read_touched(lake, stage_table(feed), feed.stage_schema, feed, raw, small)
        if small:  # row groups of other keys are skipped by their statistics
            low, high = raw.agg(F.min(feed.key), F.max(feed.key)).first()
            staged = staged.where(F.col(feed.key).between(low, high))
        merged = merge_stage(staged, rows, feed, batch_ts, dedupe=dedupe, small=small)
        path, counts = lake.write(batch, stage_table(feed), merged.drop("_op"), split_by=part_of(feed), rebalance=not small)
        return path, {"rows_inserted": counts["rows"], "rows_updated": 0}
    staged = read_touched(lake, stage_table(feed), feed.stage_schema, feed, cast_feed(raw, feed), small)
    merged = merge_stage(staged, rows, feed, batch_ts, small=small, before=True)
    path, counts = lake.write(
        batch,
        stage_table(feed),
        merged,
        replaces=True,
        split_by=part_of(feed),
        rebalance=not small or feed.month is not None,
        counters=op_counters(),
    )
    old = feed.stage_schema.replace(" ", ":").replace(",:", ", ")
    written = lake.read_paths([path], f"{feed.stage_schema}, _op string, _before struct<{old}>")
    change_path, _ = lake.write(batch, change_table(feed), change_pairs(written, batch_ts))
    return change_path, counts


def part_of(feed: Feed) -> Column:
    """The partition of a merged row: its month (`none` where that is no month), or without one a bucket of its key's hash."""
    if feed.month is None:
        return F.format_string("k%04d", F.pmod(F.xxhash64(feed.key), F.lit(feed.buckets)))
    kinds = {f.name: f.kind for f in feed.fields}
    month = F.col(feed.month) if kinds[feed.month] == "string" else month_of(feed.month)
    return F.when(month.rlike(quality.YEAR_MONTH), month).otherwise("none")


def touched_parts(lake: Lake, table: str, schema: str, feed: Feed, rows: DataFrame, small: bool) -> set[str] | None:
    """The partitions of a table that a merge of `rows` can change; None for any.

    A key's bucket follows from the key, so for bucketed tables the batch alone is looked at; a large one touches them all.
    For tables partitioned by month they are the months of rows whose key comes in, and
    the months of the incoming rows; the list of months is all that reaches the driver.
    Only keys and months are read to find them.
    """
    part = part_of(feed).alias("part")
    keys = rows.where(F.col(feed.key).isNotNull())
    if feed.month is None:
        return {row[0] for row in keys.select(part).distinct().collect()} if small else None
    keys = keys.select(feed.key)
    if small:
        keys = F.broadcast(keys)
    matched = lake.read(table, schema).select(feed.key, part).join(keys, feed.key, "left_semi")
    months = matched.select("part").unionByName(rows.select(part)).distinct()
    return {row[0] for row in months.collect()}


def read_touched(lake: Lake, table: str, schema: str, feed: Feed, rows: DataFrame, small: bool) -> DataFrame:
    """The part of a table a merge of `rows` can change."""
    return lake.read(table, schema, only=touched_parts(lake, table, schema, feed, rows, small))


def read_changes(lake: Lake, feed: Feed, after: str | None = None, until: str | None = None) -> DataFrame:
    """What staging batches later than `after`, up to `until`, changed."""
    if feed.insert_only:
        return as_inserts(lake.read(stage_table(feed), feed.stage_schema, after, until=until))
    return lake.read(change_table(feed), feed.change_schema, after, until=until)


def pending_changes(lake: Lake, feed: Feed, until: str | None = None) -> DataFrame:
    """What the next curated run carries over: the net change set of all staging batches since the last one."""
    done, source = lake.noted(f"curated/{feed.name}"), stage_table(feed) if feed.insert_only else change_table(feed)
    staged = lake.batches(source)
    waiting = staged[staged.index(done) + 1 :] if done in staged else staged
    changes = read_changes(lake, feed, done, until)
    # One batch's changes are net already; those of the insert-only feed are always.
    return changes if feed.insert_only or len(waiting) < 2 else net_changes(changes, feed.key)


def remove_keys(lake: Lake, feed: Feed, keys: DataFrame, batch_ts: dt.datetime) -> int:
    """Takes rows out of the staging table of a keyed feed; they are DELETE rows of its change table. Returns how many there were.

    Only the partitions of the keys are written again. What becomes of the targets is decided by `run_curated`'s `on_delete`.
    """
    wanted = keys.select(feed.key).where(F.col(feed.key).isNotNull()).distinct()
    table = stage_table(feed)
    rows = lake.read(table, feed.stage_schema).join(wanted, feed.key, "left_semi")
    batch = lake.begin(f"{batch_ts:%Y%m%dT%H%M%S}-remove-{feed.name}")
    at = F.lit(batch_ts).cast("timestamp_ntz").alias("_changed_at")
    gone = rows.select("*", F.lit("DELETE").alias("_action"), F.lit(False).alias("_is_update"), at)
    path, counts = lake.write(batch, change_table(feed), gone)
    if not counts["rows"]:
        return 0
    removed = lake.read_paths([path], feed.change_schema)
    touched = {row[0] for row in removed.select(part_of(feed)).distinct().collect()}
    kept = lake.read(table, feed.stage_schema, only=touched).join(removed.select(feed.key), feed.key, "left_anti")
    folder, left = lake.write(batch, table, kept, split_by=part_of(feed), register=False)
    live = lake.part_counts(folder) if left["rows"] else {}
    batch.parts += [Part(table, True, part, f"{folder}/_part={part}", live.get(part, 0)) for part in sorted(touched)]
    lake.commit(batch, batch_ts)
    return counts["rows"]


def as_inserts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_action", F.lit("INSERT")).withColumn("_is_update", F.lit(False))


def curate(
    lake: Lake, batch: Batch, feed: Feed, changes: DataFrame, batch_ts: dt.datetime, small: bool = False, on_delete: str = "keep"
) -> dict[str, int]:
    """Carry a stored change set over into the feed's target; `small` if it may be broadcast."""
    if feed.target.kind == "scd2":
        return _curate_history(lake, batch, feed, changes, batch_ts, small, on_delete)
    if feed.target.kind == "append":
        facts = append_fact(changes, feed, batch_ts)
        _, counts = lake.write(
            batch,
            target_table(feed),
            facts,
            rebalance_by=["usage_date"],
            partition_by=["usage_date"],
            sort_within=["region"],
        )
        return {"rows_inserted": counts["rows"], "rows_updated": 0}

    if feed.target.surrogate:
        sk = feed.target.surrogate
        target = read_touched(lake, target_table(feed), feed.target_schema, feed, changes, small)
        rows = target_rows(changes, feed)
        fresh = insert_absent(target, rows, [feed.key], small=small).select(feed.key)
        last = int(lake.noted(f"highest/{sk}") or 0)
        numbered = assign_keys(fresh, sk, last, feed.key)
        merged = upsert(
            target,
            rows.join(numbered, feed.key, "left"),
            [feed.key],
            update=feed.target.update or feed.columns,
            stamp=feed.target.stamp,
            batch_ts=batch_ts,
            small=small,
        )
        _, counts = lake.write(
            batch, target_table(feed), merged, replaces=True, split_by=part_of(feed), rebalance=not small, counters=op_counters()
        )
        batch.note(f"highest/{sk}", str(last + counts["rows_inserted"]))
        return counts

    target = read_touched(lake, target_table(feed), feed.target_schema, feed, changes.select(*feed.columns), small)
    merged = merge_target(target, changes, feed, batch_ts, small=small)
    _, counts = lake.write(
        batch, target_table(feed), merged, replaces=True, split_by=part_of(feed), counters=op_counters()
    )
    return counts


def _curate_history(
    lake: Lake, batch: Batch, feed: Feed, changes: DataFrame, batch_ts: dt.datetime, small: bool, on_delete: str = "keep"
) -> dict[str, int]:
    """Rewrite the current versions in the buckets of changed keys, add the ended ones to history; older history is not read.

    Both come out of one pass, split by folder.
    """
    sk = feed.target.surrogate
    touched = touched_parts(lake, DIM_CURRENT, feed.target_schema, feed, changes, small)
    current = lake.read(DIM_CURRENT, feed.target_schema, only=touched)
    last = int(lake.noted(f"highest/{sk}") or 0)
    opened = assign_keys(open_versions(changes, feed.key, feed.columns, batch_ts), sk, last, feed.key)
    ended = end_versions(current, changes, feed.key, batch_ts, on_delete, small=small)
    versions = ended.unionByName(opened).withColumn("_open", F.col("is_current")).withColumn("_part", part_of(feed))
    path, counts = lake.write(
        batch,
        "curated/dim_customer_versions",
        versions,
        rebalance_by=[] if small else ["_part"],
        partition_by=["_open", "_part"],
        counters=[
            F.count_if("is_current").alias("current"),
            F.count_if(F.col("eff_start_ts") == F.lit(batch_ts).cast("timestamp_ntz")).alias("opened"),
            F.count_if(~F.col("is_current")).alias("closed"),
        ],
        register=False,
    )
    live = lake.part_counts(f"{path}/_open=true") if counts["current"] else {}
    # A bucket that is left without a current version is replaced by nothing.
    for part in sorted(live.keys() | (touched if touched is not None else lake.part_names(DIM_CURRENT))):
        batch.parts.append(Part(DIM_CURRENT, True, part, f"{path}/_open=true/_part={part}", live.get(part, 0)))
    batch.parts.append(Part(DIM_HISTORY, False, None, f"{path}/_open=false", counts["closed"]))
    batch.note(f"highest/{sk}", str(last + counts["opened"]))
    return {"rows_inserted": counts["opened"], "rows_updated": counts["closed"]}


# -- whole layers ----------------------------------------------------------------------


# Runs of a layer at one batch time; a run's ids leave room for ten jobs in each.
ATTEMPTS = 10


class Run:
    """Run log of one layer: start rows go out before the work, end rows after it."""

    def __init__(self, lake: Lake, layer: str, batch_ts: dt.datetime, triggered_by: str = "LAYER_JOB"):
        lake.refresh()
        self.lake, self.layer, self.at, self.triggered_by = lake, layer, batch_ts, triggered_by
        self.batch_id = f"{batch_ts:%Y%m%dT%H%M%S}-{layer}"
        self.base = int(f"{batch_ts:%y%m%d%H%M%S}") * 1000 + {"raw": 0, "validate": 100, "staging": 200, "curated": 300}[layer]
        attempt = sum(b.startswith(self.batch_id) and b.endswith("-started") for b in lake.batches(EVENTS))
        if attempt >= ATTEMPTS:
            raise ValueError(f"{layer} was run {attempt} times at {batch_ts}; take another batch time")
        if attempt:
            self.batch_id += f"-again{attempt}"
            self.base += attempt * (100 // ATTEMPTS)
        self.ids: dict[str, int] = {}
        self.events: list[dict] = []
        self.errors: list[dict] = []
        self.outcomes: list[tuple] = []

    def run(self, jobs: list[tuple[str, Callable[[int], dict]]], threads: int) -> list[tuple]:
        self.ids = {job: self.base + i for i, (job, _) in enumerate(jobs)}
        load_registries(self.lake, [job for job, _ in jobs], self.at)
        self._append(
            "started", [runlog.start_event(self.ids[job], job, self.at, self.triggered_by) for job, _ in jobs], []
        )
        started = dt.datetime.now()
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(lambda j: self._one(*j, started), jobs))
        self._append("ended", self.events, self.errors)
        return self.outcomes

    def _one(self, job: str, work: Callable[[int], dict], started: dt.datetime) -> None:
        run_id = self.ids[job]
        try:
            result = work(run_id)
            at = self.at + (dt.datetime.now() - started)
            rows = {c: result.get(c, 0) for c in runlog.ROW_COUNTERS}
            self.events.append(runlog.end_event(run_id, job, at, result.get("comments", ""), self.at.date(), **rows))
            for warning, context in result.get("warnings", []):
                self.errors.append(runlog.error_row(0, run_id, job, at, "FILE_FORMAT", warning, context, "WARNING"))
            status = "WARNING" if rows["rows_rejected"] else "SUCCESS"
            self.outcomes.append((self.layer, job, status, *[rows[c] for c in _SHOWN], result.get("comments", "")))
        except Exception as error:  # one feed must not stop the others
            at = self.at + (dt.datetime.now() - started)
            message = f"{type(error).__name__}: {error}"
            context = {"layer": self.layer, "trace": traceback.format_exc()}
            self.events.append(runlog.fail_event(run_id, job, at, message, self.at.date()))
            self.errors.append(runlog.error_row(0, run_id, job, at, "SPARK_ERROR", message, context))
            self.outcomes.append((self.layer, job, "FAILED", 0, 0, 0, 0, message))

    def _append(self, step: str, events: list[dict], errors: list[dict]) -> None:
        self.lake.refresh()
        batch = self.lake.begin(f"{self.batch_id}-{step}")
        spark = self.lake.spark
        if events:
            log_events(self.lake, batch, runlog.rows_as_table(spark, events, runlog.EVENT_SCHEMA), rebalance=False)
        if errors:
            numbered = runlog.numbered(errors, int(self.lake.noted("highest/error_id") or 0))
            self.lake.write(batch, ERRORS, runlog.rows_as_table(spark, numbered, runlog.ERROR_SCHEMA))
            batch.note("highest/error_id", str(numbered[-1]["error_id"]))
        self.lake.commit(batch, self.at)


_SHOWN = ("rows_read", "rows_inserted", "rows_updated", "rows_rejected")


def _feed_batch(batch_id: str, feed: Feed) -> str:
    return f"{batch_id}-{feed.name}"


def run_raw(lake: Lake, landing: str, feeds: Iterable[Feed], batch_ts: dt.datetime, threads: int = 4) -> list[tuple]:
    """Load files not loaded before from `landing/<feed>/`. Files stay where they are."""
    run = Run(lake, "raw", batch_ts)

    def load(feed: Feed, run_id: int) -> dict:
        spark = lake.spark
        history = lake.read(f"{LOADS}/{feed.name}", files.LOAD_SCHEMA)
        new = files.unseen_files(files.list_files(spark, f"{landing}/{feed.name}"), history)
        paths = [row.path for row in new.collect()]  # file names only
        if not paths:
            return {"comments": "no new files"}
        batch = lake.begin(_feed_batch(run.batch_id, feed))
        path, counts = land(lake, batch, feed, files.read_feed(spark, feed, paths, batch_ts), batch_ts)
        lake.commit(batch, batch_ts)
        loads = lake.read(f"{LOADS}/{feed.name}", files.LOAD_SCHEMA)
        faulty = loads.where(F.col("loaded_at") == F.lit(batch_ts).cast("timestamp_ntz")).where("errors_seen > 0")
        return {
            "rows_read": counts["rows"],
            "rows_inserted": counts["rows"] - counts["rows_rejected"],
            "rows_rejected": counts["rows_rejected"],
            "comments": f"{feed.raw_table} load complete: {len(paths)} file(s)",
            "warnings": [
                (
                    f"File {r.source_file_name} had {r.errors_seen} row errors: {r.first_error}",
                    # A load goes on past any number of errors, so its limit is all rows of the file.
                    {"file": r.source_file_name, "error_limit": r.rows_parsed},
                )
                for r in faulty.orderBy("source_file_name").collect()
            ],
        }

    return run.run([(f.load_job, lambda i, f=f: load(f, i)) for f in feeds], threads)


def run_validate(
    lake: Lake,
    landing: str | None,
    feeds: Iterable[Feed],
    batch_ts: dt.datetime,
    since: dt.datetime | None = None,
    count_summary: bool = False,
    threads: int = 4,
    full_scan: bool = False,
) -> list[tuple]:
    """Check what RAW gained since the last check, one scan for all rules of a feed: errors are written, counts observed.

    How far a feed is checked is published with its errors, so a row's errors are stored once; nothing new is
    nothing read, and gives a summary of zero rows. `full_scan` or `since` check all rows, or all loaded after that time, again.
    With `landing`, row counts per file are compared with the files; `count_summary`
    adds that comparison to the rule summary.
    """
    run = Run(lake, "validate", batch_ts)

    def check(feed: Feed, run_id: int) -> dict:
        spark = lake.spark
        ctx = quality.CheckContext(run_id, feed.validate_job, feed.name, feed.raw_table, batch_ts)
        done = None if full_scan or since is not None else lake.noted(f"validated/{feed.name}")
        arrived = lake.batches(raw_table(feed))
        newest = arrived[-1] if arrived else None
        batch = lake.begin(_feed_batch(run.batch_id, feed))
        counts = dict.fromkeys(["checked", *[f"failed_{i}" for i in range(len(feed.rules))]], 0)
        waiting = newest is not None and newest != done
        if waiting:
            raw = quality.since(read_raw(lake, feed, done, newest), since)
            seen = Observation()
            watched = raw.observe(seen, *quality.rule_counters(feed.rules))
            lake.write(batch, f"{VIOLATIONS}/{feed.name}", quality.rule_errors(watched, feed.rules, feed.key, ctx))
            counts = dict(seen.get)
            batch.note(f"validated/{feed.name}", newest)
        counters = few_rows(spark, [list(counts.values())], ", ".join(f"{c} bigint" for c in counts))
        summary = quality.summarise(counters, feed.rules, ctx)
        if landing is not None and waiting:
            loads = lake.read(f"{LOADS}/{feed.name}", files.LOAD_SCHEMA, done, until=newest).select("source_file_name")
            there = files.list_files(spark, f"{landing}/{feed.name}").join(loads, "source_file_name", "left_semi")
            recon = quality.reconcile(raw, files.source_file_counts(spark, feed, [row.path for row in there.collect()]), ctx)
            path, _ = lake.write(batch, f"{COUNTS}/{feed.name}", recon)
            if count_summary:
                written = lake.read_paths([path], COUNT_SCHEMA)
                summary = summary.unionByName(quality.reconcile_summary(written, ctx))
        lake.write(batch, f"{SUMMARY}/{feed.name}", summary.coalesce(1))
        lake.commit(batch, batch_ts)
        checked = counts["checked"]
        failed = sum(n for name, n in counts.items() if name != "checked")
        return {
            "rows_read": checked,
            "rows_inserted": checked,
            "rows_rejected": failed,
            "comments": f"{feed.raw_table} validation complete: {failed} rule violation(s) across {checked} row(s)"
            if waiting
            else "no new rows",
        }

    return run.run([(f.validate_job, lambda i, f=f: check(f, i)) for f in feeds], threads)


def run_staging(
    lake: Lake,
    feeds: Iterable[Feed],
    batch_ts: dt.datetime,
    full_rescan: bool = False,
    dedupe: bool = False,
    threads: int = 4,
) -> list[tuple]:
    """Merge RAW into STAGING: what arrived since the last run, or with `full_rescan` all of it.

    `dedupe` keeps one row per key of the insert-only feed when a batch repeats a key.
    """
    run = Run(lake, "staging", batch_ts)

    def merge(feed: Feed, run_id: int) -> dict:
        done = None if full_rescan else lake.noted(f"staged/{feed.name}")
        arrived = lake.batches(raw_table(feed))
        if not arrived or arrived[-1] == done:
            return {"comments": "no new rows"}
        raw = read_raw(lake, feed, done, arrived[-1])
        name, broken, text = unusable(feed)
        ctx = quality.CheckContext(run_id, feed.stage_job, feed.name, feed.raw_table, batch_ts)
        batch = lake.begin(_feed_batch(run.batch_id, feed))
        path, _ = lake.write(
            batch, f"{DQ_CHECKS}/{feed.name}", quality.check_rows(raw, {name: (broken, text)}, ctx).coalesce(1)
        )
        check = lake.read_paths([path], DQ_SCHEMA).first()
        small = check.records_checked <= SMALL_ROWS
        _, counts = stage(lake, batch, feed, raw, batch_ts, small, dedupe)
        batch.note(f"staged/{feed.name}", arrived[-1])
        lake.commit(batch, batch_ts)
        return {
            **{c: counts[c] for c in ("rows_inserted", "rows_updated")},
            "rows_read": check.records_checked,
            "rows_rejected": check.records_failed,
            "comments": f"{feed.raw_table} -> {feed.stage_table} complete",
        }

    return run.run([(f.stage_job, lambda i, f=f: merge(f, i)) for f in feeds], threads)


def run_curated(
    lake: Lake, batch_ts: dt.datetime, threads: int = 4, feeds: Iterable[str] = CURATED_ORDER, on_delete: str = "keep"
) -> list[tuple]:
    """Carry the net changes of all feeds over. How far a target has read is published with it.

    `on_delete="close"` ends the current version of a key whose row was removed; by default it stays open.
    """
    run = Run(lake, "curated", batch_ts)

    def carry(feed: Feed, run_id: int) -> dict:
        source = stage_table(feed) if feed.insert_only else change_table(feed)
        done = lake.noted(f"curated/{feed.name}")
        staged = lake.batches(source)
        # What staging commits from here on is left to the next run.
        newest = staged[-1] if staged else None
        waiting = lake.count(source, done, newest)
        if not waiting:
            return {"comments": "no changes to merge"}
        batch = lake.begin(_feed_batch(run.batch_id, feed))
        changes = pending_changes(lake, feed, newest)
        counts = curate(lake, batch, feed, changes, batch_ts, waiting <= SMALL_ROWS, on_delete)
        batch.note(f"curated/{feed.name}", newest)
        lake.commit(batch, batch_ts)
        return {
            "rows_read": counts["rows_inserted"] + counts["rows_updated"],
            "rows_inserted": counts["rows_inserted"],
            "rows_updated": counts["rows_updated"],
            "comments": f"{feed.target.table} merge complete",
        }

    jobs = [(FEEDS[name].target.job, lambda i, f=FEEDS[name]: carry(f, i)) for name in feeds]
    return run.run(jobs, threads)


def run_layers(
    lake: Lake,
    layer: str,
    batch_ts: dt.datetime,
    landing: str | None = None,
    feeds: str | list[str] = "all",
    threads: int = 4,
    full_scan: bool = False,
) -> DataFrame:
    """Run raw, validate, staging, curated or all; returns one outcome row per job. `full_scan` checks all of RAW again."""
    chosen = pick(feeds)
    outcomes: list[tuple] = []
    if layer in ("raw", "all"):
        if landing is None:
            raise ValueError("the raw layer needs the landing folder")
        outcomes += run_raw(lake, landing, chosen, batch_ts, threads)
    if layer in ("validate", "all"):
        outcomes += run_validate(lake, landing, chosen, batch_ts, threads=threads, full_scan=full_scan)
    if layer in ("staging", "all"):
        outcomes += run_staging(lake, chosen, batch_ts, threads=threads)
    if layer in ("curated", "all"):
        outcomes += run_curated(lake, batch_ts, threads)
    return few_rows(lake.spark, outcomes, OUTCOME_SCHEMA)


# -- logs ------------------------------------------------------------------------------


def day_part() -> Column:
    """The partition of an event or a day row: the month of its run's start."""
    return F.coalesce(month_of("run_date"), F.lit("none"))


def log_events(lake: Lake, batch: Batch, events: DataFrame, rebalance: bool = True) -> None:
    lake.write(batch, EVENTS, events, split_by=day_part(), sort_within=["run_date"], rebalance=rebalance)


def run_events(lake: Lake, day: dt.date | None = None) -> DataFrame:
    """The events of all runs, or of those that started on one day, read from that day's month alone."""
    if day is None:
        return lake.read(EVENTS, runlog.EVENT_SCHEMA)
    return lake.read(EVENTS, runlog.EVENT_SCHEMA, only={f"{day:%Y-%m}"}).where(F.col("run_date") == F.lit(day))


def runs(lake: Lake, day: dt.date | None = None) -> DataFrame:
    return runlog.run_log(run_events(lake, day))


def fold_runs(lake: Lake, at: dt.datetime) -> set[str]:
    """Brings the stored day rows up to the events there are; returns the months that were worked out again.

    Only months with events since the last fold are read and replaced; how far the fold read is published with them. An
    event that comes late, the end of a run that started last month for instance, has its own month folded again.
    """
    lake.refresh()
    done, arrived = lake.noted("folded/runs"), lake.batches(EVENTS)
    if not arrived or arrived[-1] == done:
        return set()
    newest = arrived[-1]
    months = lake.part_names(EVENTS, done, newest)
    batch = lake.begin(f"fold-after-{newest}")
    events = lake.read(EVENTS, runlog.EVENT_SCHEMA, only=months, until=newest)
    days = runlog.day_rows(runlog.run_states(events, lake.count(EVENTS, until=newest, only=months)))
    lake.write(batch, RUN_DAYS, days, replaces=True, split_by=day_part(), sort_within=["run_date", "job_name"])
    batch.note("folded/runs", newest)
    lake.commit(batch, at)
    return months


def run_days(lake: Lake) -> DataFrame:
    """A row per job and day, as of the last `fold_runs`."""
    return lake.read(RUN_DAYS, runlog.DAY_SCHEMA)


def job_registry(lake: Lake) -> DataFrame:
    return lake.read(JOB_REGISTRY, runlog.JOB_SCHEMA)


def rule_registry(lake: Lake) -> DataFrame:
    return lake.read(RULE_REGISTRY, RULE_SCHEMA)


def role_regions(lake: Lake) -> DataFrame:
    """The role map that `governance.secure` takes."""
    return lake.read(REGION_REGISTRY, REGION_SCHEMA)


def add_absent(lake: Lake, batch: Batch, table: str, schema: str, rows: DataFrame, keys: list[str]) -> int:
    """Adds the rows whose key a registry does not hold; returns how many. Rows that are there keep their values."""
    path, counts = lake.write(batch, table, insert_absent(lake.read(table, schema), rows, keys), register=False)
    if counts["rows"]:
        batch.parts.append(Part(table, False, None, path, counts["rows"]))
    return counts["rows"]


def load_registries(lake: Lake, jobs: Iterable[str], at: dt.datetime) -> None:
    """Stores the fixed jobs, rules and role regions, and an AD_HOC row for each of `jobs` that no registry knows.

    The commit log notes which fixed rows and which other jobs are in, so a run that brings nothing new reads no table.
    """
    spark = lake.spark
    fixed = hashlib.sha256(repr((runlog.JOBS, quality.rule_lines(FEEDS.values()), ROLE_REGIONS)).encode()).hexdigest()
    known = {job[0] for job in runlog.JOBS}
    others = [job for job in dict.fromkeys(jobs) if job not in known and lake.noted(f"job/{job}") is None]
    stale = lake.noted("registries") != fixed
    if not others and not stale:
        return
    batch = lake.begin(f"registries-{fixed[:16]}-{uuid.uuid4().hex}")
    rows = runlog.job_rows(spark, at)
    if others:
        ran = few_rows(spark, [[job] for job in others], "job_name string")
        rows = rows.unionByName(runlog.ad_hoc_jobs(rows, ran, at))
    add_absent(lake, batch, JOB_REGISTRY, runlog.JOB_SCHEMA, rows, ["job_name"])
    if stale:
        rules = few_rows(spark, quality.rule_lines(FEEDS.values()), RULE_SCHEMA)
        add_absent(lake, batch, RULE_REGISTRY, RULE_SCHEMA, rules, ["feed_name", "column_name", "rule_type"])
        regions = few_rows(spark, ROLE_REGIONS, REGION_SCHEMA)
        add_absent(lake, batch, REGION_REGISTRY, REGION_SCHEMA, regions, ["role_name", "region"])
    batch.note("registries", fixed)
    for job in others:
        batch.note(f"job/{job}", "AD_HOC")
    lake.commit(batch, at)


def errors(lake: Lake) -> DataFrame:
    return lake.read(ERRORS, runlog.ERROR_SCHEMA)


def _all_feeds(lake: Lake, table: str, schema: str) -> DataFrame:
    return lake.read_paths([p for name in FEEDS for p in lake.parts(f"{table}/{name}")], schema)


def validation_summary(lake: Lake) -> DataFrame:
    return _all_feeds(lake, SUMMARY, SUMMARY_SCHEMA)


def validation_errors(lake: Lake) -> DataFrame:
    return _all_feeds(lake, VIOLATIONS, VALIDATION_ERROR_SCHEMA)


def count_log(lake: Lake) -> DataFrame:
    return _all_feeds(lake, COUNTS, COUNT_SCHEMA)


def dq_checks(lake: Lake) -> DataFrame:
    return _all_feeds(lake, DQ_CHECKS, DQ_SCHEMA)


def day_report(lake: Lake, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """The day's run statistics, from its month's events alone, and the twenty newest open errors."""
    day = runlog.run_states(run_events(lake, as_of))
    return reports.daily_summary(day, as_of), reports.newest_open_errors(errors(lake), runlog.run_states(run_events(lake)))
