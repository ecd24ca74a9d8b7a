"""Records of CSV files whose quoted cells hold line breaks, over splittable files.

Whether a line starts inside a quoted cell depends on every line before it. Each line is a small function: where it
ends if it starts outside a cell, and where if it starts inside. Chains of such functions are again one of four kinds
(stay, swap, always outside, always inside), so running sums within a split, and over the splits of a file, tell every
line's place; no task reads a file from its start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines one record may have; a stray quote would otherwise make one record of all the rest of a file.
RECORD_LINES = 10_000
# A whole quoted cell, its start marked by the line's or by a comma; text behind its closing quote belongs to it.
WHOLE_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?!")[^,]*'
OPENED_CELL = r'(^|,)"'
CLOSED_CELL = r'^[^"]*+(?:""[^"]*+)*+"(?!")'


def ends_inside(line: Column) -> Column:
    """Whether a line that starts outside a quoted cell ends inside one."""
    return F.regexp_replace(line, WHOLE_CELL, "$1").rlike(OPENED_CELL)


def stays_inside(line: Column) -> Column:
    """Whether a line that starts inside a quoted cell ends inside one."""
    # Behind the closing quote comes the rest of that cell, then further cells.
    rest = F.concat(F.lit("."), F.regexp_replace(line, CLOSED_CELL, ""))
    return F.when(line.rlike(CLOSED_CELL), ends_inside(rest)).otherwise(F.lit(True))


def _after(fixed: Column, swaps: Column, start: Column) -> Column:
    """Inside or not, after a chain of functions with so many swaps since the one that fixed it, if one did."""
    return F.coalesce(fixed, start) != (swaps % 2 == 1)


def numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, split, at, value) of every line; a split is one task's lines, in the order of ``at``."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def marked(lines: DataFrame) -> DataFrame:
    """Lines with ``record`` (split and place of the line their record starts at), ``open`` (whether they end inside a
    cell) and ``header`` (whether that record is the file's first)."""
    inside = Window.partitionBy("path", "split").orderBy("at")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swap, fix = F.col("_out") & ~F.col("_in"), F.col("_out") == F.col("_in")
    chained = (
        lines.withColumns({"_out": ends_inside(F.col("value")), "_in": stays_inside(F.col("value"))})
        .withColumn("_swaps", F.sum(swap.cast("int")).over(running))
        # Where a line fixes the place, what it fixed is kept free of the swaps before it.
        .withColumn("_fixed", F.last(F.when(fix, F.col("_out") != (F.col("_swaps") % 2 == 1)), True).over(running))
    )
    # One row per split: its whole chain, and from these where each split starts.
    splits = chained.groupBy("path", "split").agg(F.max_by(F.struct("_swaps", "_fixed"), "at").alias("c"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    odd, ended = F.col("c._swaps") % 2, F.col("c._fixed") != (F.col("c._swaps") % 2 == 1)
    total = F.sum(odd).over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = splits.withColumn("_total", total).withColumn("_set", F.when(ended.isNotNull(), ended != (F.col("_total") % 2 == 1)))
    starts = ranked.select(
        F.col("path").alias("_p"), F.col("split").alias("_s"),
        _after(F.last("_set", True).over(before), F.coalesce(F.sum(odd).over(before), F.lit(0)), F.lit(False)).alias("_start"),
    )
    placed = chained.join(starts, (F.col("path") == F.col("_p")) & (F.col("split") == F.col("_s"))).drop("_p", "_s")
    placed = placed.withColumn("open", _after(F.col("_fixed"), F.col("_swaps"), F.col("_start")))
    begins = ~F.coalesce(F.lag("open").over(inside), F.col("_start"))
    placed = placed.withColumn("_own", F.last(F.when(begins, F.struct("split", "at")), True).over(running))
    # A record that an earlier split began.
    last = placed.groupBy("path", "split").agg(F.max("_own").alias("_own"))
    carried = last.select(F.col("path").alias("_p"), F.col("split").alias("_s"), F.last("_own", True).over(before).alias("_earlier"))
    found = placed.join(carried, (F.col("path") == F.col("_p")) & (F.col("split") == F.col("_s")))
    first = F.min(F.struct("split", "at")).over(Window.partitionBy("path", "split"))
    record = F.coalesce("_own", "_earlier")
    return found.select(
        "path", "split", "at", "value", "open", record.alias("record"), ((record == first) & (record["split"] == 0)).alias("header")
    )


def open_files(lines: DataFrame, most: int = RECORD_LINES) -> DataFrame:
    """path of the files in which a record has more lines than `most`, the header has line breaks, or the last cell is
    never closed."""
    rows = marked(lines)
    long = rows.groupBy("path", "record").agg(F.count(F.lit(1)).alias("n"), F.max("header").alias("header"))
    long = long.where((F.col("n") > most) | (F.col("header") & (F.col("n") > 1))).select("path")
    ends = rows.groupBy("path").agg(F.max_by("open", F.struct("split", "at")).alias("open")).where("open").select("path")
    return long.union(ends).distinct()


def records(lines: DataFrame) -> DataFrame:
    """(path, text) of each record but the header; blank ones are left out, as in files without quoted line breaks."""
    whole = F.array_sort(F.collect_list(F.struct("split", "at", "value")))
    text = F.array_join(F.transform(whole, lambda x: x["value"]), "\n")
    joined = marked(lines).where(~F.col("header")).groupBy("path", "record").agg(text.alias("text"))
    return joined.select("path", F.regexp_replace("text", "\r$", "").alias("text")).where(F.trim("text") != "")
