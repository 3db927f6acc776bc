"""Surrogate keys without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def assign_keys(rows: DataFrame, name: str, after: int, order: str) -> DataFrame:
    """Number `rows` after + 1, after + 2, ... in the order of the unique column `order`.

    Rows are range-partitioned and sorted, then checkpointed, which fixes both the
    partitions and the order inside them also when an executor is lost. The number is
    the row's position in its partition plus the rows of all partitions before it;
    that running sum is over one row per partition.
    """
    scratch_dir(rows.sparkSession)
    fixed = rows.repartitionByRange(order).sortWithinPartitions(order).checkpoint()
    placed = fixed.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_id", _ROW_BITS)
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_offset"))
    position = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.lit(after) + F.col("_offset") + position + 1).cast("bigint").alias(name), *rows.columns
    )
