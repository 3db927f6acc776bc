"""Change sets carried over into dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.feeds import Feed
from millrace.functions.casts import minutes_between
from millrace.operators.changes import latest_inserts
from millrace.operators.merge import insert_absent, upsert


def target_rows(changes: DataFrame, feed: Feed) -> DataFrame:
    """What a change set contributes to its target: newest row per key, derived columns added.

    The insert-only feed contributes each of its rows.
    """
    if feed.target.kind == "append":
        rows = changes.where("_action = 'INSERT'").select(*feed.columns)
    else:
        rows = latest_inserts(changes, feed.key).select(*feed.columns)
    if feed.name == "cdr":
        rows = rows.withColumn("usage_date", F.to_date("call_start_ts"))
    if feed.name == "support_tickets":
        rows = rows.withColumn("resolution_minutes", minutes_between("opened_at", "closed_at").cast("decimal(10,0)"))
    return rows


def merge_target(
    target: DataFrame, changes: DataFrame, feed: Feed, batch_ts: dt.datetime, small: bool = False
) -> DataFrame:
    """Type-1 dimension or keyed fact after a batch, with `_op` per row."""
    return upsert(
        target,
        target_rows(changes, feed),
        [feed.key],
        update=feed.target.update,
        stamp=feed.target.stamp,
        batch_ts=batch_ts,
        small=small,
    )


def append_fact(changes: DataFrame, feed: Feed, batch_ts: dt.datetime, seen: DataFrame | None = None) -> DataFrame:
    """Rows to add to an append-only fact.

    With `seen`, the fact so far, a change set that is carried over twice adds nothing.
    """
    rows = target_rows(changes, feed)
    if seen is not None:
        rows = insert_absent(seen, rows, [feed.key])
    return rows.withColumn(feed.target.stamp, F.lit(batch_ts).cast("timestamp_ntz"))
