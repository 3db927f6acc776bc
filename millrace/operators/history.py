"""Type-2 history of a dimension.

Closed versions never change. Ending and opening versions therefore work on the current
rows and the change set alone; history is only ever added to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.changes import keys_ending_in, latest_inserts


def end_versions(
    current: DataFrame,
    changes: DataFrame,
    key: str,
    batch_ts: dt.datetime,
    on_delete: str = "keep",
    small: bool = False,
) -> DataFrame:
    """The current rows after a batch: those of changed keys are ended at `batch_ts`.

    A key whose newest change is a DELETE is left alone, or ended with
    `on_delete="close"`.
    """
    ending = keys_ending_in(changes, key, "INSERT")
    if on_delete == "close":
        ending = ending.unionByName(keys_ending_in(changes, key, "DELETE"))
    ending = ending.withColumn("_ends", F.lit(True))
    ended = F.col("_ends").isNotNull()
    return (
        current.join(F.broadcast(ending) if small else ending, key, "left")
        .withColumn("eff_end_ts", F.when(ended, F.lit(batch_ts).cast("timestamp_ntz")).otherwise(F.col("eff_end_ts")))
        .withColumn("is_current", ~ended)
        .select(*current.columns)
    )


def open_versions(changes: DataFrame, key: str, attributes: Sequence[str], batch_ts: dt.datetime) -> DataFrame:
    """One new current version per key whose newest change is an INSERT, from `batch_ts` on."""
    return latest_inserts(changes, key).select(
        *attributes,
        F.lit(batch_ts).cast("timestamp_ntz").alias("eff_start_ts"),
        F.lit(None).cast("timestamp_ntz").alias("eff_end_ts"),
        F.lit(True).alias("is_current"),
    )


def scd2_apply(
    dimension: DataFrame,
    changes: DataFrame,
    key: str,
    attributes: Sequence[str],
    batch_ts: dt.datetime,
    on_delete: str = "keep",
) -> DataFrame:
    """The whole dimension after a batch, without surrogate keys."""
    names = [*attributes, "eff_start_ts", "eff_end_ts", "is_current"]
    history = dimension.where(~F.col("is_current")).select(*names)
    current = dimension.where(F.col("is_current")).select(*names)
    return (
        history.unionByName(end_versions(current, changes, key, batch_ts, on_delete))
        .unionByName(open_versions(changes, key, attributes, batch_ts))
    )
