"""What the operators of this folder share: written tables, slices of Arrow batches, samples of labels."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir

# Words are runs of anything but ASCII white space; the same pattern for Spark and the SQL checks.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the one that all executors share."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder; cuts the lineage, and outlives lost executors."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def aside(docs: DataFrame, *kept: str) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with all columns but `kept` under names that clash with none of an operator's, and the way back."""
    held = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in kept}
    return docs.withColumnsRenamed(held), {v: k for k, v in held.items()}


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(divisor))


def label_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, keep: Column, seed: int) -> DataFrame:
    """At most `rows` labelled ids of each class that `docs` holds, those with the smallest seeded hashes.

    The bound counts ids of `docs` only, so labels of other documents take no place. An id with two different labels takes no part. Only the two hashes at which the sample
    ends reach the driver, so the result, at most 2 * `rows` rows, may be broadcast.
    """
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    one = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & keep)
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_top"))
        .where(F.col("label") == F.col("_top"))
        .join(there, "doc_id", "left_semi")
        .select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64(F.lit(seed), "doc_id").alias("_at"))
    )
    ends = {}
    for kind in (0, 1):
        found = one.where(F.col("label") == kind).select("_at").orderBy("_at").limit(rows).agg(F.max("_at")).first()[0]
        ends[kind] = found
    inside = F.lit(False)
    for kind, end in ends.items():
        if end is not None:
            inside = inside | ((F.col("label") == kind) & (F.col("_at") <= F.lit(end)))
    return one.where(inside).select("doc_id", "label")


def sampled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`doc_id`, `label` and text of the sampled ids, one row of each: that with the smallest text hash.

    An id that many rows repeat is one training document, so the sample's bound is one of rows too.
    """
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = thin.join(F.broadcast(ids), "doc_id")
    return marked.groupBy("doc_id").agg(F.min("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))


def string_parts(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; nulls have no bytes."""
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, kind, len(array) + 1, array.offset * np.dtype(kind).itemsize).astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece has about `limit` bytes of text; a longer text comes alone."""
    for batch in batches:
        if not len(batch):
            continue
        column = batch.column(text)
        _, ends = string_parts(column)
        at = 0
        while at < len(batch):
            to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), len(batch))
            yield batch.slice(at, to - at)
            at = to
