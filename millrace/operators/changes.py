"""Change capture between two states of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.latest import latest_by_key, newest_first, total_order


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Net changes as rows with `_action` and `_is_update`.

    A new key gives INSERT, a lost key DELETE, a changed row the pair DELETE (old) and
    INSERT (new) with `_is_update` true. Null to value is a change here. `columns` are
    the ones compared, all by default. Both states hold a key once.
    """
    names = after.columns
    compared = [c for c in (columns or names) if c not in keys]
    left = before.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*names).alias("_before"))
    right = after.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*names).alias("_after"))
    joined = left.join(right, [F.col(f"_b_{k}") == F.col(f"_a_{k}") for k in keys], "full_outer")

    old, new = F.col("_before"), F.col("_after")
    same = [old[c].eqNullSafe(new[c]) for c in compared]
    differs = old.isNull() | new.isNull()
    for equal in same:
        differs = differs | ~equal
    both = old.isNotNull() & new.isNotNull()
    sides = F.array(
        F.when(old.isNotNull(), F.struct(old.alias("row"), F.lit("DELETE").alias("_action"), both.alias("_is_update"))),
        F.when(new.isNotNull(), F.struct(new.alias("row"), F.lit("INSERT").alias("_action"), both.alias("_is_update"))),
    )
    return joined.where(differs).select(F.inline(F.array_compact(sides))).select("row.*", "_action", "_is_update")


def appended_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only capture: rows whose key was not there before."""
    return (
        after.join(before.select(*keys), list(keys), "left_anti")
        .withColumn("_action", F.lit("INSERT"))
        .withColumn("_is_update", F.lit(False))
    )


def replay(before: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply a change set: `replay(a, snapshot_diff(a, b))` is `b`."""
    touched = changes.select(*keys).distinct()
    inserted = changes.where("_action = 'INSERT'").select(*before.columns)
    return before.join(touched, list(keys), "left_anti").unionByName(inserted)


def net_changes(changes: DataFrame, key: str) -> DataFrame:
    """The change set that those of several batches make together, from the state before the first to that after the last.

    Two updates are one pair, of the first old row and the last new one; an insert that is updated stays an insert; an
    insert that is deleted is nothing; an update that is deleted is a DELETE of the first old row. `_changed_at` is the last change's. Rows of
    one key are added up before the shuffle.
    """
    names = [c for c in changes.columns if c not in ("_action", "_is_update", "_changed_at")]
    order = F.struct("_changed_at", F.when(F.col("_action") == "DELETE", 0).otherwise(1))
    row = F.struct(F.struct(*names).alias("row"), "_action")
    both = changes.groupBy(F.col(key).alias("_key")).agg(
        F.min_by(row, order).alias("_first"), F.max_by(row, order).alias("_last"), F.max("_changed_at").alias("_changed_at")
    )
    old = F.when(F.col("_first._action") == "DELETE", F.col("_first.row"))
    new = F.when(F.col("_last._action") == "INSERT", F.col("_last.row"))
    pair = old.isNotNull() & new.isNotNull()
    sides = F.array_compact(
        F.array(
            F.when(old.isNotNull(), F.struct(old.alias("row"), F.lit("DELETE").alias("_action"))),
            F.when(new.isNotNull(), F.struct(new.alias("row"), F.lit("INSERT").alias("_action"))),
        )
    )
    return both.select("_changed_at", pair.alias("_is_update"), F.inline(sides)).select("row.*", "_action", "_is_update", "_changed_at")


def latest_inserts(changes: DataFrame, key: str, stamp: str = "updated_at") -> DataFrame:
    """The newest INSERT per key of a change set that may span several batches.

    Of a DELETE and an INSERT at the same time the INSERT is newer, as in an update pair.
    """
    lead = [c for c in ("_changed_at", stamp, "_action") if c in changes.columns]
    rows = changes.drop("_is_update")
    return latest_by_key(rows, [key], total_order(rows, [key], lead)).where("_action = 'INSERT'")


def keys_ending_in(changes: DataFrame, key: str, action: str, stamp: str = "updated_at") -> DataFrame:
    """Keys whose newest change is `action`. Only key, time and action are shuffled."""
    at = "_changed_at" if "_changed_at" in changes.columns else stamp
    rows = changes.select(key, at, "_action")
    newest = latest_by_key(rows, [key], newest_first(at, "_action"))
    return newest.where(F.col("_action") == action).select(key)


def has_changes(changes: DataFrame) -> bool:
    return not changes.isEmpty()
