"""The newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Row number one per key.

    Catalyst turns the rank filter into a window group limit on both sides of the
    shuffle: each map task sends at most one row per key, so a key that holds a third
    of all rows costs no more to shuffle than any other.
    `order` should be total, otherwise ties fall anywhere; see `total_order`.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def total_order(df: DataFrame, keys: Sequence[str], lead: Sequence[str]) -> list[Column]:
    """Newest by the lead columns, then by every other column but the keys.

    The extra columns are compared only between rows that tie on the lead, and rows
    that tie on all of them are equal, so the winner is always the same row.
    """
    rest = [c for c in df.columns if c not in lead and c not in keys]
    return newest_first(*lead, *rest)
