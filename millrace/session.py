"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Wall-clock columns are TIMESTAMP_NTZ; UTC keeps casts from and to TIMESTAMP neutral.
# AQE sizes, coalesces and skew-splits shuffle partitions from run-time statistics.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "millrace", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share for checkpoints and intermediate tables.

    It is what `spark.checkpoint.dir` names. Only a local master may go without it;
    it then gets a temporary folder, once per session.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="millrace-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def few_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A handful of rows, log entries for instance, as a one-partition frame without Python tasks."""
    struct = StructType.fromDDL(schema)
    fields = struct.names
    table = pa.Table.from_pylist([dict(zip(fields, row, strict=True)) for row in rows], schema=arrow_schema(struct))
    return spark.createDataFrame(table, struct).coalesce(1)


def arrow_schema(struct: StructType) -> pa.Schema:
    kinds = {
        "string": pa.string(),
        "bigint": pa.int64(),
        "boolean": pa.bool_(),
        "date": pa.date32(),
        "timestamp_ntz": pa.timestamp("us"),
    }
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in struct.fields])
