"""Keyed merges written as joins: a new state comes out, nothing is changed in place."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.latest import latest_by_key, total_order

# A source of at most this many rows may be broadcast. By its declared widths a feed row
# is under 1,000 characters, 4 kB at most, so this bounds the broadcast table at 200 MB.
# Callers know the count of rows they wrote or checked before.
SMALL_ROWS = 50_000

Side = Callable[[str], Column]


def tracked_change(columns: Sequence[str]) -> Callable[[Side, Side], Column]:
    """True when a tracked column differs. A null on either side is no difference."""

    def differs(old: Side, new: Side) -> Column:
        anyone = reduce(Column.__or__, [old(c) != new(c) for c in columns])
        return F.coalesce(anyone, F.lit(False))

    return differs


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    when: Callable[[Side, Side], Column] | None = None,
    stamp: str | None = None,
    batch_ts: dt.datetime | None = None,
    small: bool = False,
    before: bool = False,
) -> DataFrame:
    """The target after the merge, with `_op` = insert, update or keep per row.

    With `before`, `_before` holds an updated row as it was; null for the others.

    `source` holds each key once and no null key. A match overwrites the `update`
    columns (default: all the source has) if `when` holds, and the stamp with them;
    other columns keep their first value. A new key is inserted with every source
    column; target columns the source lacks are null there.

    One full outer join does it. With `small` (at most SMALL_ROWS rows) the source is broadcast
    and the target is not shuffled: a left join for the matches, and an anti join
    against the matched keys, of which there are no more than source rows.
    """
    now = F.lit(batch_ts).cast("timestamp_ntz")
    taken = [c for c in target.columns if c in source.columns]
    overwritten = [c for c in (taken if update is None else update) if c not in keys]
    incoming = source.select(*[F.col(c).alias(f"_new_{c}") for c in taken], F.lit(True).alias("_new"))
    existing = target.withColumn("_old", F.lit(True))

    def old(c: str) -> Column:
        return F.col(c)

    def new(c: str) -> Column:
        return F.col(f"_new_{c}")

    is_insert = F.col("_old").isNull()
    is_update = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    if when is not None:
        is_update = is_update & when(old, new)

    def resolve(c: str) -> Column:
        if c == stamp:
            return F.when(is_insert | is_update, now).otherwise(old(c)).alias(c)
        if c not in taken:
            return old(c)
        if c in keys:
            return F.coalesce(old(c), new(c)).alias(c)
        return F.when(is_insert | is_update if c in overwritten else is_insert, new(c)).otherwise(old(c)).alias(c)

    op = F.when(is_insert, "insert").when(is_update, "update").otherwise("keep").alias("_op")
    told = [op]
    if before:
        told.append(F.when(is_update, F.struct(*[old(c).alias(c) for c in target.columns])).alias("_before"))
    on = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    if not small:
        joined = existing.join(incoming, on, "full_outer")
        return joined.select(*[resolve(c) for c in target.columns], *told)

    matched = existing.join(F.broadcast(incoming), on, "left")
    kept = matched.select(*[resolve(c) for c in target.columns], *told)
    types = {f.name: f.dataType for f in target.schema.fields}
    absent = insert_absent(target, source, keys, small=True)
    inserted = absent.select(
        *[
            (now if c == stamp else F.col(c) if c in taken else F.lit(None).cast(types[c])).alias(c)
            for c in target.columns
        ],
        F.lit("insert").alias("_op"),
        *([F.lit(None).cast(target.schema).alias("_before")] if before else []),
    )
    return kept.unionByName(inserted)


def insert_absent(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    dedupe: bool = False,
    small: bool = False,
) -> DataFrame:
    """Source rows whose key the target lacks.

    A key twice in the source gives two rows, unless `dedupe`. Only the key columns of
    the target are read; with `small` they are not shuffled either.
    """
    if dedupe:
        source = latest_by_key(source, keys, total_order(source, keys, ()))
    known = target.select(*keys)
    if small:
        wanted = F.broadcast(source.select(*keys).distinct())
        known = F.broadcast(known.join(wanted, list(keys), "left_semi").distinct())
    return source.join(known, list(keys), "left_anti")


def state(merged: DataFrame) -> DataFrame:
    """The table to store after a merge."""
    return merged.drop("_op")


def op_counters() -> list[Column]:
    """rows_inserted, rows_updated and rows_kept, for agg() or observe()."""
    return [
        F.count_if(F.col("_op") == op).alias(name)
        for op, name in (("insert", "rows_inserted"), ("update", "rows_updated"), ("keep", "rows_kept"))
    ]


def merge_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(*op_counters())


def change_pairs(merged: DataFrame, at: dt.datetime) -> DataFrame:
    """The change set of a merge with before-images: an update is a DELETE of the old row and an INSERT of the new one.

    `_changed_at` is the time of the batch, by which change sets of several batches are put in order.
    """
    names = [c for c in merged.columns if c not in ("_op", "_before")]
    updated = F.col("_op") == "update"
    side = lambda row, action: F.struct(row.alias("row"), F.lit(action).alias("_action"))
    sides = F.array_compact(F.array(F.when(updated, side(F.col("_before"), "DELETE")), side(F.struct(*names), "INSERT")))
    return (
        merged.where("_op <> 'keep'")
        .select(updated.alias("_is_update"), F.inline(sides))
        .select("row.*", "_action", "_is_update", F.lit(at).cast("timestamp_ntz").alias("_changed_at"))
    )


def changes_of(merged: DataFrame) -> DataFrame:
    """The net change set a merge produced, without comparing the two states.

    New and rewritten rows with `_action` INSERT, the form the carried-over merges read.
    """
    return (
        merged.where("_op <> 'keep'")
        .withColumn("_action", F.lit("INSERT"))
        .withColumn("_is_update", F.col("_op") == "update")
        .drop("_op")
    )
