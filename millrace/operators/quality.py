"""Row rules, their summary and error rows, and file count reconciliation.

Rules observe; they never gate a load. A rule is a boolean column, so any number of
rules costs one scan: the summary is one aggregation, the errors one explode.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import to_date_or_null, to_timestamp_or_null

YEAR_MONTH = r"\A[0-9]{4}-(0[1-9]|1[0-2])\z"


@dataclass(frozen=True)
class NotNull:
    column: str
    rule_type = "NOT_NULL"

    def broken(self) -> Column:
        return F.col(self.column).isNull()

    @property
    def reason(self) -> str:
        return f"{self.column} is NULL"

    @property
    def detail(self) -> str:
        return f"{self.column} must not be null"


@dataclass(frozen=True)
class Parses:
    """Null passes; text that does not parse breaks the rule."""

    column: str
    kind: str = "date"
    hint: str = " (expected YYYY-MM-DD)"
    rule_type = "DATE_FORMAT"

    def broken(self) -> Column:
        parse = to_date_or_null if self.kind == "date" else to_timestamp_or_null
        return F.col(self.column).isNotNull() & parse(self.column).isNull()

    @property
    def reason(self) -> str:
        return f"{self.column} is not a parseable {self.kind}{self.hint}"

    @property
    def detail(self) -> str:
        return f"Must parse as a {self.kind}{self.hint}"


@dataclass(frozen=True)
class Matches:
    column: str
    pattern: str = YEAR_MONTH
    label: str = "YYYY-MM"
    rule_type = "DATE_FORMAT"

    def broken(self) -> Column:
        return F.coalesce(~F.col(self.column).rlike(self.pattern), F.lit(False))

    @property
    def reason(self) -> str:
        return f"{self.column} does not match {self.label}"

    @property
    def detail(self) -> str:
        return f"Must match {self.label}"


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple[str, ...]
    any_case: bool = False
    rule_type = "ACCEPTED_VALUES"

    def broken(self) -> Column:
        value = F.upper(self.column) if self.any_case else F.col(self.column)
        return F.coalesce(~value.isin(*self.values), F.lit(False))

    @property
    def reason(self) -> str:
        return f"{self.column} not in ({self.detail})"

    @property
    def detail(self) -> str:
        return ", ".join(self.values)


Rule = NotNull | Parses | Matches | Accepted


@dataclass(frozen=True)
class CheckContext:
    """What every log row carries: which run, for which feed, at what time."""

    run_id: int
    job_name: str
    feed_name: str
    table_name: str
    at: dt.datetime

    def columns(self) -> list[Column]:
        return [
            F.lit(self.run_id).cast("bigint").alias("run_id"),
            F.lit(self.job_name).alias("job_name"),
            F.lit(self.feed_name).alias("feed_name"),
            F.lit(self.table_name).alias("table_name"),
        ]

    def time(self) -> Column:
        return F.lit(self.at).cast("timestamp_ntz")


def since(raw: DataFrame, load_ts: dt.datetime | None) -> DataFrame:
    """Rows loaded after `load_ts`; everything when it is None."""
    if load_ts is None:
        return raw
    return raw.where(F.col("_load_ts") > F.lit(load_ts).cast("timestamp_ntz"))


def rule_counters(rules: Sequence[Rule]) -> list[Column]:
    """`checked` and one `failed_<i>` per rule, for agg() or observe()."""
    counters = [F.count(F.lit(1)).alias("checked")]
    counters += [F.count_if(rule.broken()).alias(f"failed_{i}") for i, rule in enumerate(rules)]
    return counters


def summarise(counts: DataFrame, rules: Sequence[Rule], ctx: CheckContext) -> DataFrame:
    """Turn the one wide row of `rule_counters` into one row per rule."""
    lines = [
        F.struct(
            F.lit(rule.rule_type).alias("rule_type"),
            F.lit(rule.column).alias("column_name"),
            F.col("checked").alias("records_checked"),
            F.col(f"failed_{i}").alias("records_failed"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines))).select(
        *ctx.columns(),
        "rule_type",
        "column_name",
        "records_checked",
        "records_failed",
        F.when(F.col("records_failed") == 0, "PASS").otherwise("FAIL").alias("check_status"),
        ctx.time().alias("checked_at"),
    )


def rule_summary(raw: DataFrame, rules: Sequence[Rule], ctx: CheckContext) -> DataFrame:
    """Checked, failed and PASS/FAIL per rule, rules nobody breaks included."""
    return summarise(raw.agg(*rule_counters(rules)), rules, ctx)


def rule_errors(raw: DataFrame, rules: Sequence[Rule], key: str, ctx: CheckContext) -> DataFrame:
    """One row per (record, broken rule), with the whole record as JSON."""
    record = [c for c in raw.columns if c not in ("source_file_name", "_load_ts")]
    broken = [
        F.when(
            rule.broken(),
            F.struct(
                F.lit(rule.rule_type).alias("rule_type"),
                F.lit(rule.column).alias("column_name"),
                F.col(rule.column).alias("failed_value"),
                F.lit(rule.reason).alias("error_reason"),
            ),
        )
        for rule in rules
    ]
    any_broken = reduce(Column.__or__, [rule.broken() for rule in rules])
    return (
        raw.where(any_broken)  # clean rows, nearly all of them, never build the array
        .select(
            F.col(key).alias("record_key"),
            "source_file_name",
            F.to_json(F.struct(*record, "source_file_name", "_load_ts")).alias("raw_record"),
            F.col("_load_ts").alias("load_ts"),
            F.inline(F.array_compact(F.array(*broken))),
        )
        .select(
            *ctx.columns(),
            "rule_type",
            "column_name",
            "record_key",
            "failed_value",
            "error_reason",
            "source_file_name",
            "raw_record",
            "load_ts",
            ctx.time().alias("logged_at"),
            F.lit(False).alias("is_resolved"),
            F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
            F.lit(None).cast("string").alias("resolved_by"),
        )
    )


def file_counts(rows: DataFrame, name: str) -> DataFrame:
    """Rows per source file; rows without provenance stand outside reconciliation."""
    return (
        rows.where(F.col("source_file_name").isNotNull())
        .groupBy("source_file_name")
        .agg(F.count(F.lit(1)).alias(name))
    )


def reconcile(raw: DataFrame, source_counts: DataFrame, ctx: CheckContext) -> DataFrame:
    """Landed rows against rows in the file, for every file that landed.

    `source_counts` has source_file_name and source_row_count; a file missing there
    can no longer be read and is SKIPPED.
    """
    source, target = F.col("source_row_count"), F.col("target_row_count")
    return (
        file_counts(raw, "target_row_count")
        .join(source_counts, "source_file_name", "left")
        .select(
            F.lit(ctx.run_id).cast("bigint").alias("run_id"),
            F.lit(ctx.feed_name).alias("feed_name"),
            F.lit(ctx.table_name).alias("table_name"),
            "source_file_name",
            "source_row_count",
            "target_row_count",
            (target - source).alias("row_count_variance"),
            F.when(source.isNull(), "SKIPPED").when(source == target, "MATCH").otherwise("MISMATCH").alias("check_status"),
            ctx.time().alias("checked_at"),
        )
    )


def reconcile_summary(recon: DataFrame, ctx: CheckContext) -> DataFrame:
    """The reconciliation as one more summary row: files compared and files off."""
    return recon.agg(
        F.count_if(F.col("check_status") != "SKIPPED").alias("records_checked"),
        F.count_if(F.col("check_status") == "MISMATCH").alias("records_failed"),
    ).select(
        *ctx.columns(),
        F.lit("ROW_COUNT_RECONCILIATION").alias("rule_type"),
        F.lit(None).cast("string").alias("column_name"),
        "records_checked",
        "records_failed",
        F.when(F.col("records_failed") == 0, "PASS").otherwise("FAIL").alias("check_status"),
        ctx.time().alias("checked_at"),
    )


def check_rows(raw: DataFrame, checks: dict[str, tuple[Column, str]], ctx: CheckContext) -> DataFrame:
    """Named counters of a load: {check_name: (broken, text)} in one aggregation."""
    names = list(checks)
    counts = raw.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(checks[name][0]).alias(f"failed_{i}") for i, name in enumerate(names)],
    )
    lines = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(checks[name][1]).alias("check_sql"),
            F.col("checked").alias("records_checked"),
            F.col(f"failed_{i}").alias("records_failed"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*lines))).select(
        F.lit(ctx.run_id).cast("bigint").alias("run_id"),
        F.lit(ctx.job_name).alias("job_name"),
        "check_name",
        F.lit(ctx.table_name).alias("table_name"),
        "check_sql",
        "records_checked",
        "records_failed",
        F.when(F.col("records_failed") == 0, "PASS").otherwise("FAIL").alias("check_status"),
        ctx.time().alias("checked_at"),
    )


def rule_lines(feeds: Iterable) -> list[tuple[str, ...]]:
    """The rule objects rendered: feed, table, column, type, text."""
    lines = []
    for feed in feeds:
        lines.append((feed.name, feed.raw_table, "ALL", "ROW_COUNT_RECONCILIATION", "Rows per source file against rows landed"))
        lines += [(feed.name, feed.raw_table, r.column, r.rule_type, r.detail) for r in feed.rules]
    return lines


def rules_table(spark: SparkSession, feeds: Iterable) -> DataFrame:
    """The rule objects as a catalogue."""
    return spark.createDataFrame(
        rule_lines(feeds), "feed_name string, table_name string, column_name string, rule_type string, rule_detail string"
    )
