"""Landing rows to typed rows, one per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.feeds import Feed
from millrace.functions.casts import cast_text, to_timestamp_or_null
from millrace.operators.latest import latest_by_key, total_order
from millrace.operators.merge import insert_absent, tracked_change, upsert

PROVENANCE = ("_load_ts", "source_file_name")


def unusable(feed: Feed) -> tuple[str, Column, str]:
    """The load check of a feed: its name, the rows it rejects, and its text."""
    if feed.insert_only:
        broken = F.col(feed.key).isNull() | to_timestamp_or_null("call_start_ts").isNull()
        return "NULL_KEY_OR_BAD_TS", broken, f"{feed.key} IS NULL OR call_start_ts not parseable"
    return (
        f"NULL_{feed.key.upper()}",
        F.col(feed.key).isNull(),
        f"SELECT COUNT(*) FROM {feed.raw_table} WHERE {feed.key} IS NULL",
    )


def cast_feed(raw: DataFrame, feed: Feed) -> DataFrame:
    return raw.select(
        *[f.name if f.kind == "string" else cast_text(f.name, f.kind).alias(f.name) for f in feed.fields]
    )


def stage_rows(raw: DataFrame, feed: Feed, dedupe: bool | None = None) -> DataFrame:
    """Usable rows of RAW, newest per key, cast to their types.

    Insert-only feeds keep every usable row unless `dedupe` is set. The pick is made on
    the text columns, so only surviving rows are parsed.
    """
    _, broken, _ = unusable(feed)
    rows = raw.where(~broken).select(*feed.columns, *PROVENANCE)
    if dedupe if dedupe is not None else not feed.insert_only:
        rows = latest_by_key(rows, [feed.key], total_order(rows, [feed.key], PROVENANCE))
    return cast_feed(rows, feed)


def merge_stage(
    staged: DataFrame,
    rows: DataFrame,
    feed: Feed,
    batch_ts: dt.datetime,
    dedupe: bool = False,
    small: bool = False,
    before: bool = False,
) -> DataFrame:
    """Merge `stage_rows` output into the staging table; adds `_op` per row, and with `before` the old row of an update.

    Insert-only feeds return just the new rows, all with `_op` insert.
    """
    if feed.insert_only:
        fresh = insert_absent(staged, rows, [feed.key], dedupe=dedupe, small=small)
        stamp = F.lit(batch_ts).cast("timestamp_ntz").alias("updated_at")
        return fresh.select(*feed.columns, stamp, F.lit("insert").alias("_op"))
    return upsert(
        staged,
        rows,
        [feed.key],
        update=feed.update,
        when=tracked_change(feed.gate) if feed.gate else None,
        stamp="updated_at",
        batch_ts=batch_ts,
        small=small,
        before=before,
    )
