"""Feed files to landing rows: null tokens, provenance, rejects, load history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from millrace.feeds import Feed
from millrace.sources.records import BLANKS, file_records, from_files, parsed, record_counts

Reader = TypeVar("Reader", DataFrameReader, DataStreamReader)

# Text that stands for null in a feed file.
NULL_TOKENS = ("", "NULL", "null", "NA")

CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "enforceSchema": "true"}

# The parser of streamed rows gives the text of a record, `_raw`, only if its fields are not as many as the columns. With these
# columns beyond the feed's, that is every record but one of exactly so many surplus fields. Batches are read by `records`.
PAST = [f"_past{i}" for i in range(7)]
UNCLOSED, BEHIND = "malformed: a quote is not closed", "malformed: text behind a closing quote"

LOAD_SCHEMA = (
    "feed_name string, source_file_name string, rows_parsed bigint, rows_loaded bigint, "
    "errors_seen bigint, first_error string, first_error_line bigint, loaded_at timestamp_ntz"
)


def blank_to_null(c: str) -> Column:
    return F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c))


def for_feed(reader: Reader, feed: Feed, multiline: bool | None = None) -> Reader:
    """The reader, batch or stream, set to the feed's delimited files: its columns, PAST and `_raw`.

    With line breaks in quotes, a record ends at a line feed outside of them; a carriage return before it is cut off.
    """
    multiline = feed.multiline if multiline is None else multiline
    reader = reader.schema(", ".join(f"{c} string" for c in [*feed.columns, *PAST, "_raw"])).options(**CSV_OPTIONS)
    reader = reader.option("columnNameOfCorruptRecord", "_raw").option("multiLine", multiline)
    return reader.option("lineSep", "\n") if multiline else reader


def not_blank(records: DataFrame) -> DataFrame:
    """Without the lines that hold white space only; the parser leaves them out itself when it reads by lines."""
    first = F.coalesce(records[0], F.lit(""))
    return records.where((F.btrim(first, F.lit(BLANKS)) != "") | F.coalesce(F.btrim("_raw", F.lit(BLANKS)) != "", F.lit(True)))


def malformed() -> Column:
    """What is wrong with the quotes of a record; null if nothing is. The numbers of its fields do not matter.

    A quote opens a value only as its first character. The text is cut at the quotes; the state says where a piece
    lies: 0 outside of quotes, 1 inside, 2 behind a quote that closes or is doubled, 3 behind a closed value that goes on.
    """
    pieces = F.split(F.concat(F.lit(","), F.col("_raw")), '"', -1)

    def step(state: Column, piece: Column) -> Column:
        opens = piece.endswith(",").cast("int")
        return (
            F.when(state == 0, opens)
            .when(state == 1, 2)
            .when((state == 2) & (piece == ""), 1)
            .when((state == 2) & F.ltrim(piece, F.lit(BLANKS)).startswith(","), opens)
            .otherwise(3)
        )

    state = F.aggregate(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.lit(0), step)
    rest = F.ltrim(F.element_at(pieces, -1), F.lit(BLANKS))
    end = F.when((state == 2) & (rest != "") & ~rest.startswith(","), 3).otherwise(state)
    reasons = F.element_at(F.array(F.lit(UNCLOSED), F.lit(None), F.lit(BEHIND)), F.nullif(end, F.lit(0)))
    return F.when(F.col("_raw").contains('"'), reasons)


def unseen(feed: Feed) -> Column:
    """Of a streamed record without its text, a value that may come of broken quotes is taken for one."""
    odd = [F.coalesce(F.col(c).startswith('"') | F.col(c).contains("\n"), F.lit(False)) for c in [*feed.columns, *PAST]]
    return F.when(F.col("_raw").isNull() & reduce(lambda a, b: a | b, odd), F.lit(BEHIND))


def landing_rows(lines: DataFrame, feed: Feed, load_ts: Column) -> DataFrame:
    """Null tokens out, provenance and load time in. `lines` reads from files; if by `for_feed`, broken ones get `_malformed`."""
    provenance = F.col("_metadata.file_path").alias("source_file_name")
    kept: list[str] = ["source_file_name"]
    if "_raw" in lines.columns:
        kept.append("_malformed")
        lines = not_blank(lines)
        broken = F.coalesce(malformed(), unseen(feed)).alias("_malformed")
        lines = lines.select(*[without_return(c).alias(c) for c in feed.columns], provenance, broken)
    else:
        lines = lines.select(*feed.columns, provenance)
    columns = [blank_to_null(c).alias(c) for c in feed.columns]
    return lines.select(*columns, kept[0], load_ts.cast("timestamp_ntz").alias("_load_ts"), *kept[1:])


def without_return(c: str) -> Column:
    """The value without the carriage return of its line's end, which `_raw` lacks."""
    value = F.col(c)
    cut = F.left(value, F.char_length(value) - 1)
    return F.when(value.endswith("\r") & F.col("_raw").endswith(cut), cut).otherwise(value)


def feed_rows(lines: DataFrame, feed: Feed, load_ts: Column) -> DataFrame:
    """Landing rows from lines as `records.from_files` gives them, with `_malformed` and `_line`, where the record begins in its file."""
    rows = parsed(file_records(lines), feed.columns)
    columns = [blank_to_null(c).alias(c) for c in feed.columns]
    return rows.select(*columns, "source_file_name", load_ts.cast("timestamp_ntz").alias("_load_ts"), malformed().alias("_malformed"), "_line")


def text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return from_files(spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths)))


def read_feed(
    spark: SparkSession,
    feed: Feed,
    paths: str | Sequence[str],
    load_ts: dt.datetime,
    multiline: bool | None = None,
) -> DataFrame:
    """Delimited files by position into the feed's columns, every one a string, and `_malformed`.

    Short rows end in nulls and surplus fields are dropped. Line breaks inside quotes belong to the value, and plain
    files are split between tasks all the same; `_line` is where a record begins. With `multiline=False`, by default the feed's, each line is a record.
    """
    if feed.multiline if multiline is None else multiline:
        return feed_rows(text_lines(spark, paths), feed, F.lit(load_ts))
    lines = for_feed(spark.read, feed, False).csv(paths if isinstance(paths, str) else list(paths))
    return landing_rows(lines, feed, F.lit(load_ts))


def read_json_feed(
    spark: SparkSession, feed: Feed, paths: str | Sequence[str], load_ts: dt.datetime, array: bool = True
) -> DataFrame:
    """JSON files holding an array of records, or with `array=False` a record per line."""
    lines = (
        spark.read.schema(feed.landing_schema)
        .option("multiLine", array)
        .json(paths if isinstance(paths, str) else list(paths))
    )
    return landing_rows(lines, feed, F.lit(load_ts))


def reject_reason(feed: Feed) -> Column:
    """Why a row cannot be stored: its first over-long value. Null for good rows."""
    return F.coalesce(
        *[
            F.when(
                F.length(f.name) > f.width,
                F.concat(F.lit(f"{f.name} is longer than {f.width}: "), F.length(f.name).cast("string")),
            )
            for f in feed.fields
        ]
    )


def flag_rejects(rows: DataFrame, feed: Feed) -> DataFrame:
    """`rows` with `_reject`, and `_line` as the last column (null without one); what was found wrong when the line was parsed comes first."""
    line = F.col("_line") if "_line" in rows.columns else F.lit(None).cast("bigint")
    rows = rows.withColumn("_at_line", line).drop("_line").withColumnRenamed("_at_line", "_line")
    reason = reject_reason(feed)
    if "_malformed" in rows.columns:
        reason = F.coalesce("_malformed", reason)
    return rows.withColumn("_reject", reason).select(*[c for c in rows.columns if c not in ("_malformed", "_line")], "_reject", "_line")


def good_rows(rows: DataFrame, feed: Feed) -> DataFrame:
    """Rows that load. One predicate per column: the optimizer multiplies a predicate
    over many columns by every later renaming of one of them."""
    if "_malformed" in rows.columns:
        rows = rows.where(F.col("_malformed").isNull()).drop("_malformed")
    for f in feed.fields:
        rows = rows.where(F.col(f.name).isNull() | (F.length(f.name) <= f.width))
    return rows.drop("_line")


def split_rejects(rows: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """Rows that load and rows that do not; the latter with `_reject`, the reason."""
    return good_rows(rows, feed), flag_rejects(rows, feed).where(F.col("_reject").isNotNull())


def load_report(flagged: DataFrame, feed: Feed, load_ts: dt.datetime) -> DataFrame:
    """Per file: rows parsed, loaded and refused, and the first refused line's reason and number.

    Without line numbers the reasons go by their text.
    """
    refused = F.col("_reject").isNotNull()
    first = F.min(F.when(refused, F.struct(F.coalesce("_line", F.lit(0)).alias("at"), "_reject", "_line")))
    return (
        flagged.groupBy("source_file_name")
        .agg(
            F.count(F.lit(1)).alias("rows_parsed"),
            F.count_if(~refused).alias("rows_loaded"),
            F.count_if(refused).alias("errors_seen"),
            first.alias("_first"),
        )
        .withColumns({"first_error": F.col("_first._reject"), "first_error_line": F.col("_first._line")})
        .drop("_first")
        .select(F.lit(feed.name).alias("feed_name"), "*", F.lit(load_ts).cast("timestamp_ntz").alias("loaded_at"))
    )


def load_totals(report: DataFrame) -> DataFrame:
    return report.groupBy("feed_name").agg(
        F.count(F.lit(1)).alias("files"),
        *[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "errors_seen")],
    )


def _empty_if_missing(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """A folder no file has arrived in yet, or whose files are all gone, holds nothing."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv*") -> DataFrame:
    """Files under a folder: `source_file_name`, as rows name it, and `path`, to read it by. Only names are listed; no content is read."""

    def read() -> DataFrame:
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(folder)
            .select(F.col("_metadata.file_path").alias("source_file_name"), "path")
        )

    return _empty_if_missing(spark, read, "source_file_name string, path string")


def unseen_files(listed: DataFrame, history: DataFrame) -> DataFrame:
    """Listed files that no earlier load has taken in."""
    return listed.join(history.select("source_file_name"), "source_file_name", "left_anti")


def source_file_counts(spark: SparkSession, feed: Feed, paths: str | Sequence[str]) -> DataFrame:
    """Data lines per file, counted in the files themselves; all files in one scan."""
    schema = "source_file_name string, source_row_count bigint"
    if not paths:
        return spark.createDataFrame([], schema)

    def read() -> DataFrame:
        if feed.multiline:
            return record_counts(text_lines(spark, paths), "source_row_count")
        lines = for_feed(spark.read, feed).csv(paths if isinstance(paths, str) else list(paths))
        records = not_blank(lines).select(F.col("_metadata.file_path").alias("source_file_name"))
        return records.groupBy("source_file_name").agg(F.count(F.lit(1)).alias("source_row_count"))

    return _empty_if_missing(spark, read, schema)
