"""Records of delimited files whose quoted values may hold line breaks, with every file split between tasks.

Files are read as lines, which Spark splits by block. Whether a line break lies in quotes hangs on all that comes
before it in the file, but only by one bit: a line begins outside of quotes or inside. So a line is a function of that bit, one of four:
it keeps it, turns it over, or sets it to one of both. Functions of neighbouring lines make one, and so a block has one
too. A first scan gives a row for each block, a running composition over a file's blocks the bit at the start of each.

A file in which no line ends inside of quotes has a record on every line, and its lines stay where they are. In the others
the lines of a block are put in order, and those that break a record are joined to it; a record that runs over the end of a block is
owned by the block it begins in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

BLANKS = "".join(map(chr, range(33)))  # what a blank line is made of, and what may stand between a closing quote and a delimiter
LONGEST = 1_000_000  # characters of a record; one that is longer is taken for a quote left open

PLACE = ("source_file_name", "_block")


def with_places(lines: DataFrame) -> DataFrame:
    """`value`, file and block of lines as read, with `_at`, which grows along a block by one."""
    return lines.select("value", *PLACE, F.monotonically_increasing_id().alias("_at"))


def from_files(lines: DataFrame) -> DataFrame:
    """The text and the place of lines of a text source, batch or stream."""
    return lines.select("value", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.file_block_start").alias(PLACE[1]))


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line that begins inside or outside of quotes ends inside.

    The line is cut at its quotes, and the state says where a piece lies: 0 outside of quotes, 1 inside, 2 behind a quote that
    closes or is doubled, 3 in a value that goes on behind its closing quote, up to the next delimiter. A quote opens a value only as its first character.
    """
    pieces = F.split(line if inside else F.concat(F.lit(","), line), '"', -1)

    def step(state: Column, piece: Column) -> Column:
        opens = piece.endswith(",").cast("int")
        return (
            F.when(state == 0, opens)
            .when(state == 1, 2)
            .when((state == 2) & (piece == ""), 1)
            .when((state == 2) & F.ltrim(piece, F.lit(BLANKS)).startswith(","), opens)
            .otherwise(F.when(piece.contains(","), opens).otherwise(3))
        )

    state = F.aggregate(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.lit(int(inside)), step)
    return F.when(line.contains('"'), state == 1).otherwise(F.lit(inside))


def _is_blank(text: Column) -> Column:
    """Nearly all texts are told by their first character: those of BLANKS all come before the exclamation mark."""
    return F.when(text >= "!", F.lit(False)).otherwise(F.btrim(text, F.lit(BLANKS)) == "")


def _composed(rows: DataFrame, window: Window, set_to: Column, turns: Column) -> DataFrame:
    """`_set` and `_turned`: what the functions of all earlier rows of the window make together.

    A row's function sets the bit to `set_to`, or if that is null turns it over if `turns`. The last that sets it counts, and the
    turns after that one.
    """
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_turns", F.sum(turns.cast("int")).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(set_to.isNotNull(), F.struct(set_to.alias("bit"), F.col("_turns").alias("turns"))), ignorenulls=True).over(earlier)
    so_far = F.coalesce(F.max("_turns").over(earlier), F.lit(0))
    rows = rows.withColumn("_last", last).withColumn("_before", so_far)
    odd = (F.col("_before") - F.coalesce(F.col("_last.turns"), F.lit(0))) % 2 == 1
    return rows.withColumn("_set", F.col("_last.bit") != odd).withColumn("_turned", odd).drop("_turns", "_last", "_before")


def _applied(bit: Column) -> Column:
    return F.coalesce(F.col("_set"), bit != F.col("_turned"))


def _functions(lines: DataFrame) -> DataFrame:
    """The lines with `_out` and `_in`: whether they end inside of quotes when they begin outside, and inside."""
    return lines.withColumns({"_out": ends_inside(F.col("value"), False), "_in": ends_inside(F.col("value"), True)})


def _set_to(out: Column, within: Column) -> Column:
    return F.when(out == within, out)


def _fix_splits(spark: SparkSession) -> None:
    """Every scan of a file has to find the same blocks; without this setting their size follows the cores there are at the time."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def block_rows(lines: DataFrame) -> DataFrame:
    """A row per file and block: its first `_at`, lines before it, lines that aren't blank, the place of the file's first of those, and if the file breaks records.

    One row of each block leaves its task. The rows are checkpointed: the lines are scanned once to find them, whatever is made of them.
    """
    scratch_dir(lines.sparkSession)
    _fix_splits(lines.sparkSession)
    found = lines.groupBy(*PLACE).agg(
        F.min("_at").alias("_first"),
        F.count("*").alias("_lines"),
        F.bool_or(ends_inside(F.col("value"), False)).alias("_breaks"),
        F.min(F.when(~_is_blank(F.col("value")), F.col("_at"))).alias("_head"),
        F.count_if(~_is_blank(F.col("value"))).alias("_filled"),
    )
    whole = Window.partitionBy("source_file_name")
    ordered = whole.orderBy("_block")
    before = F.coalesce(F.sum("_lines").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    head = F.min(F.when(F.col("_head").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("_head").alias("at")))).over(whole)
    return found.select(
        *PLACE, "_first", before.alias("_before_block"), "_filled", head.alias("_header"), F.bool_or("_breaks").over(whole).alias("_broken")
    ).checkpoint()


def _numbered(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The lines with `_line`, their number in the file from 1, and what `blocks` says of their place."""
    return lines.join(F.broadcast(blocks), list(PLACE)).withColumn("_line", F.col("_before_block") + F.col("_at") - F.col("_first") + 1)


def _joined(lines: DataFrame) -> DataFrame:
    """Records of files that break some: file, first line's number, text, and if the first line is the file's first that isn't blank."""
    block = Window.partitionBy(*PLACE).orderBy("_at")
    rows = _functions(lines)
    rows = _composed(rows, block, _set_to(F.col("_out"), F.col("_in")), F.col("_out") & ~F.col("_in"))
    # What the block's lines make together, and how many of them begin outside, for both bits it may begin with.
    ends = [F.when(_applied(F.lit(b)), F.col("_in")).otherwise(F.col("_out")) for b in (False, True)]
    blocks = rows.groupBy(*PLACE).agg(
        *[F.max_by(end, "_at").alias(f"_end{i}") for i, end in enumerate(ends)],
        *[F.count_if(~_applied(F.lit(b))).alias(f"_begun{i}") for i, b in enumerate((False, True))],
    )
    chain = Window.partitionBy("source_file_name").orderBy("_block")
    blocks = _composed(blocks, chain, _set_to(F.col("_end0"), F.col("_end1")), F.col("_end0") & ~F.col("_end1"))
    blocks = blocks.withColumn("_inside", _applied(F.lit(False)))
    begun = F.when(F.col("_inside"), F.col("_begun1")).otherwise(F.col("_begun0"))
    after = F.lead("_block").over(chain)
    owner = F.last(F.when(begun > 0, F.struct(F.col("_block").alias("block"), begun.alias("n"), after.alias("after"))), ignorenulls=True)
    blocks = blocks.select(*PLACE, "_inside", owner.over(chain.rowsBetween(Window.unboundedPreceding, -1)).alias("_owner"))

    rows = rows.join(F.broadcast(blocks), list(PLACE)).withColumn("_begins", ~_applied(F.col("_inside")))
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {"_record": F.sum(F.col("_begins").cast("long")).over(so_far), "_chars": F.sum(F.length("value") + 1).over(so_far)}
    )
    rows = rows.withColumn("_from", F.max(F.when(F.col("_begins"), F.col("_chars") - F.length("value") - 1)).over(so_far))
    ends_in = F.when(F.col("_begins"), F.col("_out")).otherwise(F.col("_in"))
    head = F.struct(F.col("_block").alias("block"), F.col("_at").alias("at")) == F.col("_header")
    one = rows.where(F.col("_begins") & ~ends_in).select("source_file_name", "_line", F.col("value").alias("_raw"), head.alias("_is_header"))

    parts = rows.where(~F.col("_begins") | ends_in)
    # What is LONGEST characters behind the beginning of its record, surely so if that lies in an earlier block, is not gathered.
    far = F.coalesce(F.col("_block") - F.col("_owner.after") > 4 * LONGEST, F.lit(False)) & (F.col("_record") == 0)
    parts = parts.where(F.col("_begins") | ((F.col("_chars") - F.coalesce("_from", F.lit(0)) <= LONGEST + F.length("value")) & ~far))
    here = F.struct(F.col("_block").alias("block"), F.col("_record").alias("n"))
    own = F.when(F.col("_record") > 0, here).otherwise(F.struct("_owner.block", "_owner.n"))
    gathered = parts.groupBy("source_file_name", own.alias("_own")).agg(
        F.min("_line").alias("_line"),
        F.sum(F.length("value") + 1).alias("_chars"),
        F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("_parts"),
        F.bool_or(head).alias("_is_header"),
    )
    # A record longer than that is a quote left open, as its first line alone is.
    text = F.when(F.col("_chars") <= LONGEST, F.array_join(F.transform("_parts", lambda p: p["value"]), "\n")).otherwise(F.col("_parts")[0]["value"])
    return one.unionByName(gathered.select("source_file_name", "_line", text.alias("_raw"), "_is_header"))


def file_records(lines: DataFrame) -> DataFrame:
    """`source_file_name`, `_line` (number of its first line, from 1) and `_raw` (its text) of every record but the first of each file, its header.

    `lines` is what `from_files` gives. Blank lines outside of quotes are no records. The carriage return at the end of a record is cut off.
    """
    lines = with_places(lines)
    return _records(lines, block_rows(lines))


def _records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    numbered = _numbered(lines, blocks.select(*PLACE, "_first", "_before_block", "_header", "_broken"))
    head = F.struct(F.col("_block").alias("block"), F.col("_at").alias("at")) == F.col("_header")
    records = numbered.where(~F.col("_broken")).select("source_file_name", "_line", F.col("value").alias("_raw"), head.alias("_is_header"))
    broken = blocks.where("_broken").select(*PLACE, "_first", "_before_block", "_header")
    if not broken.isEmpty():
        records = records.unionByName(_joined(_numbered(lines, broken)))
    raw = F.when(F.col("_raw").endswith("\r"), F.left("_raw", F.length("_raw") - 1)).otherwise(F.col("_raw"))
    return records.where(~F.col("_is_header") & ~_is_blank(F.col("_raw"))).select("source_file_name", "_line", raw.alias("_raw"))


def record_counts(lines: DataFrame, name: str) -> DataFrame:
    """How many of `file_records` each file has that has some; a file without broken records is scanned once, for its blocks."""
    lines = with_places(lines)
    blocks = block_rows(lines)
    filled = blocks.where(~F.col("_broken")).groupBy("source_file_name").agg((F.sum("_filled") - 1).alias(name)).where(F.col(name) > 0)
    broken = blocks.where("_broken")
    if broken.isEmpty():
        return filled
    joined = _records(lines.join(F.broadcast(broken.select(*PLACE)), list(PLACE), "left_semi"), broken)
    return filled.unionByName(joined.groupBy("source_file_name").agg(F.count(F.lit(1)).alias(name)))


def parsed(records: DataFrame, columns: list[str]) -> DataFrame:
    """Records cut into the columns by position, each a string; short ones end in nulls and surplus fields are dropped."""
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "lineSep": "\n"}
    fields = F.from_csv("_raw", ", ".join(f"{c} string" for c in columns), options)
    return records.withColumn("_fields", fields).select(*[F.col("_fields")[c].alias(c) for c in columns], *records.columns)
