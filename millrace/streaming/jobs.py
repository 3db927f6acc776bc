"""Structured Streaming forms of the layer jobs.

A micro-batch is one batch of the lake. Its id is made of the feed, the stream's id, which
Spark keeps in the checkpoint, and the batch's number: one that Spark replays after a failure
finds itself committed and is skipped, while another feed or a new checkpoint begins anew.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.feeds import Feed
from millrace.operators.changes import has_changes
from millrace.operators.staging import stage_rows
from millrace.operators.merge import SMALL_ROWS
from millrace.plans.layers import as_inserts, curate, land, raw_table, stage
from millrace.sources.files import feed_rows, for_feed, good_rows, landing_rows
from millrace.sources.records import from_files
from millrace.sources.tables import Lake


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of new files, with their places and the time of the micro-batch; each file is split between tasks."""
    reader = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch)
    return from_files(reader.text(folder)).withColumn("_load_ts", F.current_timestamp().cast("timestamp_ntz"))


def stream_feed_files(spark: SparkSession, feed: Feed, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of a folder as landing rows that stay a stream; all rows of a micro-batch share its time. One task reads a file."""
    lines = for_feed(spark.readStream, feed).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return landing_rows(lines, feed, F.current_timestamp())


def stream_raw(lake: Lake, feed: Feed, folder: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Each file lands in RAW exactly once."""

    def take(rows: DataFrame, at: dt.datetime, batch_id: str) -> None:
        batch = lake.begin(batch_id)
        land(lake, batch, feed, rows, at)
        lake.commit(batch, at)

    return _start(lake, feed, folder, take, checkpoint, trigger)


def stream_to_target(
    lake: Lake, feed: Feed, folder: str, checkpoint: str, trigger: dict | None = None, dedupe: bool = True
) -> StreamingQuery:
    """Files to RAW, STAGING and the curated target, all published together per micro-batch.

    Works for the append-only usage fact, the type-1 tables and the type-2 dimension.
    The insert-only feed keeps one row per key; a key that comes late is just a new key.
    """

    def take(rows: DataFrame, at: dt.datetime, batch_id: str) -> None:
        batch = lake.begin(batch_id)
        raw_path, counts = land(lake, batch, feed, rows, at)
        raw = lake.read_paths([raw_path], f"{feed.raw_schema}, _reject string").where("_reject IS NULL").drop("_reject")
        path, _ = stage(lake, batch, feed, raw, at, small=counts["rows"] <= SMALL_ROWS, dedupe=dedupe)
        if feed.insert_only:
            changes = as_inserts(lake.read_paths([path], feed.stage_schema))
        else:
            changes = lake.read_paths([path], feed.change_schema)
        if has_changes(changes):
            curate(lake, batch, feed, changes, at, small=counts["rows"] <= SMALL_ROWS)
        batch.note(f"staged/{feed.name}", batch_id)
        batch.note(f"curated/{feed.name}", batch_id)
        lake.commit(batch, at)

    return _start(lake, feed, folder, take, checkpoint, trigger)


def stream_distinct(rows: DataFrame, feed: Feed, delay: str = "1 day") -> DataFrame:
    """Typed stream rows, one per key within `delay` of event time.

    The bounded-state form: keys older than the watermark are forgotten, so state stays
    the size of `delay` and not of the table.
    """
    event_time = F.col("call_start_ts").cast("timestamp")
    typed = stage_rows(good_rows(rows, feed), feed, dedupe=False).withColumn("_event_time", event_time)
    return typed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([feed.key]).drop("_event_time")


def _batch_time(rows: DataFrame) -> dt.datetime | None:
    """The time all rows of the micro-batch carry; None if it has none."""
    first = rows.select("_load_ts").first()
    return first and first[0]


def _start(
    lake: Lake,
    feed: Feed,
    folder: str,
    take: Callable[[DataFrame, dt.datetime, str], None],
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    name = f"{feed.name}-{uuid.uuid4().hex}"

    def numbered(rows: DataFrame, number: int) -> None:
        stream = next(q.id for q in lake.spark.streams.active if q.name == name)
        batch_id = f"stream-{feed.name}-{stream}-{number:09d}"
        lake.refresh()
        at = None if batch_id in lake.batches(raw_table(feed)) else _batch_time(rows)
        if at is not None:
            take(feed_rows(rows.drop("_load_ts"), feed, F.lit(at)) if feed.multiline else rows, at, batch_id)

    source = stream_lines(lake.spark, folder) if feed.multiline else stream_feed_files(lake.spark, feed, folder)
    return (
        source.writeStream.queryName(name)
        .foreachBatch(numbered)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
