"""Layer tables as folders of Parquet parts, published by an append-only commit log.

A batch writes its parts to new folders and then appends its rows to the log. Readers
follow the log, so nothing being read is ever overwritten, a job that dies before its
commit leaves no trace, and all tables of a batch appear together. A batch that was
committed is refused if it is written again. A merge that knows which partitions it
touches replaces only those.

One writer per table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import few_rows

COMMIT_SCHEMA = (
    "table_name string, batch_id string, seq bigint, replaces boolean, part string, path string, "
    "row_count bigint, committed_at timestamp_ntz"
)


class Part(NamedTuple):
    """A folder that is added to a table, or stands in for the table or one partition of it."""

    table: str
    replaces: bool
    part: str | None
    path: str
    rows: int


@dataclass
class Batch:
    """Parts written but not yet published."""

    batch_id: str
    parts: list[Part] = field(default_factory=list)

    def note(self, name: str, value: str) -> None:
        """Publish a small value along with the tables, such as how far a reader got."""
        self.parts.append(Part(f"note:{name}", True, None, value, 0))


class Lake:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/commits"
        self._rows: list | None = None
        self._lock = threading.RLock()
        spark.createDataFrame([], COMMIT_SCHEMA).write.mode("ignore").parquet(f"{self._log}/commit=none")

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self._log).drop("commit")

    def refresh(self) -> None:
        """Forget the log as read so far; what other writers have published since shows up."""
        with self._lock:
            self._rows = None

    def _entries(self, table: str) -> list:
        """Log rows of one table, oldest first: a few per batch, never data. Read once, then kept."""
        with self._lock:
            if self._rows is None:
                self._rows = sorted(self.commits().collect(), key=lambda r: (r.seq, r.batch_id))
            return [r for r in self._rows if r.table_name == table]

    def noted(self, name: str) -> str | None:
        entries = self._entries(f"note:{name}")
        return entries[-1].path if entries else None

    def batches(self, table: str) -> list[str]:
        return list(dict.fromkeys(row.batch_id for row in self._entries(table)))

    def _live(self, table: str, after: str | None = None, until: str | None = None) -> dict[str | None, list]:
        """Log rows that make up the table by partition, or those added since batch `after`; none later than `until`."""
        live: dict[str | None, list] = {}
        entries = self._entries(table)
        if until is not None:
            entries = entries[: max(i for i, row in enumerate(entries) if row.batch_id == until) + 1]
        for row in entries:
            if row.replaces and row.part is None:
                live = {}
            elif row.replaces:
                live[row.part] = []
            if row.row_count:
                live.setdefault(row.part, []).append(row)
            if row.batch_id == after:
                live = {}
        return live

    def parts(
        self, table: str, after: str | None = None, only: Collection[str] | None = None, until: str | None = None
    ) -> list[str]:
        """Folders of the table; `only` limits them to some partitions."""
        live = self._live(table, after, until)
        return [row.path for part, rows in live.items() if only is None or part in only for row in rows]

    def part_names(self, table: str, after: str | None = None, until: str | None = None) -> set[str]:
        """Partitions that the table has rows in, or those that batches later than `after`, up to `until`, added to."""
        return {part for part, rows in self._live(table, after, until).items() if rows and part is not None}

    def count(
        self, table: str, after: str | None = None, until: str | None = None, only: Collection[str] | None = None
    ) -> int:
        """Rows according to the log; no data is read."""
        live = self._live(table, after, until)
        return sum(row.row_count for part, rows in live.items() if only is None or part in only for row in rows)

    def read(
        self,
        table: str,
        schema: str,
        after: str | None = None,
        only: Collection[str] | None = None,
        until: str | None = None,
    ) -> DataFrame:
        """The table, or what batches later than `after`, up to `until`, added. Empty if there is nothing."""
        paths = self.parts(table, after, only, until)
        return self.read_paths(paths, schema, base=paths[0].split("/batch=")[0] if paths else None)

    def read_paths(self, paths: Sequence[str], schema: str, base: str | None = None) -> DataFrame:
        """Folders as one table; `base` is the folder above them if they are partitioned."""
        struct = StructType.fromDDL(schema)
        if not paths:
            return self.spark.createDataFrame([], struct)
        reader = self.spark.read.schema(struct)
        if base:
            reader = reader.option("basePath", base)
        return reader.parquet(*paths).select(*struct.names)

    def begin(self, batch_id: str) -> Batch:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r} is no folder name")
        return Batch(batch_id)

    def write(
        self,
        batch: Batch,
        table: str,
        df: DataFrame,
        replaces: bool = False,
        rebalance_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        sort_within: Sequence[str] = (),
        split_by: Column | None = None,
        rebalance: bool = True,
        counters: Sequence[Column] = (),
        register: bool = True,
    ) -> tuple[str, dict[str, int]]:
        """Write a part; returns its folder and the counts `rows` plus the counters.

        Counts are taken in the writing stage, where a task's figures enter once however
        often the task runs. `rebalance_by` groups rows into files of even size: small
        groups share a file and a large one is split over several tasks. With `split_by`
        each value becomes a partition that later batches can replace by itself; its rows are rebalanced too unless
        `rebalance` is false, for rows that come from a few partitions' files as they lie.
        """
        if batch.batch_id in self.batches(table):
            raise ValueError(f"{table} already holds batch {batch.batch_id}")
        if split_by is not None:
            df = df.withColumn("_part", split_by)
            partition_by = ["_part"]
            rebalance_by = partition_by if rebalance else ()
        if rebalance_by:
            df = df.hint("rebalance", *[F.col(c) for c in rebalance_by])
        if sort_within:
            df = df.sortWithinPartitions(*partition_by, *sort_within)
        seen = Observation()
        path = f"{self.root}/{table}/batch={batch.batch_id}"
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counters).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        counts = dict(seen.get)
        if split_by is not None and counts["rows"] and register:
            batch.parts += [Part(table, replaces, part, f"{path}/_part={part}", n) for part, n in self.part_counts(path).items()]
        elif split_by is not None:
            pass  # no partition is touched
        elif register:
            batch.parts.append(Part(table, replaces, None, path, counts["rows"]))
        return path, counts

    def part_counts(self, path: str) -> dict[str, int]:
        """Rows of each partition of a written folder, from its files' footers."""
        written = self.spark.read.schema("_part string").parquet(path).groupBy("_part").count().collect()
        return {r["_part"]: r["count"] for r in written}

    def commit(self, batch: Batch, at: dt.datetime) -> None:
        """Publish all parts of the batch as one file in a log folder of its own.

        Writers of different tables may therefore commit at the same time. A folder that a
        commit left without rows when it died is written over; one with rows is refused.
        """
        if not batch.parts:
            return
        with self._lock:
            known = F.max(F.col("batch_id") == batch.batch_id).alias("known")
            last = self.commits().agg(F.coalesce(F.max("seq"), F.lit(0)).alias("seq"), known).first()
            if last.known:
                raise ValueError(f"batch {batch.batch_id} is already committed")
            seq = last.seq + 1
            rows = [(p.table, batch.batch_id, seq, p.replaces, p.part, p.path, p.rows, at) for p in batch.parts]
            folder = f"{self._log}/commit={batch.batch_id}"
            few_rows(self.spark, rows, COMMIT_SCHEMA).write.mode("overwrite").parquet(folder)
            self._rows = None
        batch.parts = []
