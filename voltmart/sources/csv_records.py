"""Records of CSV files whose quoted cells hold line feeds, without reading a file in one task.

A line begins inside a quoted cell or outside of one, and its text alone says what either start leads to: it keeps the
state, swaps it, or sets it. Such steps compose in any grouping, so the state before each line follows from a running
composition within the file block and one over the blocks of a file (one row per block). Lines that begin outside are
where records begin; a record that reaches over the end of a block is put together from its pieces.

Only files that have a line with an odd number of quotes come here. A quote within an unquoted cell is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# a whole quoted cell at its place (doubled quotes stand for one), and a quoted cell that the line leaves open
CLOSED_CELL = '(^|,)"[^"]*+(?:""[^"]*+)*+"(?!")'
OPEN_CELL = '(^|,)"'


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """f (path), b (start of the file block), name, r (ascending within a block), text."""
    return (spark.read.option("lineSep", "\n").text(list(files))
            .select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                    F.col("_metadata.file_name").alias("name"), F.monotonically_increasing_id().alias("r"), F.col("value").alias("text")))


def files_with_open_lines(spark: SparkSession, files: Sequence[str]) -> set[str]:
    """Those of `files` (as Spark writes their paths) with a line that holds an odd number of quotes: one narrow scan,
    a flag per file reaches the driver."""
    text = F.col("text")
    odd = (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
    return {r["f"] for r in _lines(spark, files).where(odd).select("f").distinct().collect()}


def files_with_lines(spark: SparkSession, files: Sequence[str], pattern: str) -> set[str]:
    """Those of `files` (as Spark writes their paths) with a line in which `pattern` is found: one narrow scan of the text,
    without cutting it into cells."""
    return {r["f"] for r in _lines(spark, files).where(F.col("text").rlike(pattern)).select("f").distinct().collect()}


def _left_open(text: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside of them."""
    return F.when(text.contains('"'), F.regexp_like(F.regexp_replace(text, CLOSED_CELL, "$1"), F.lit(OPEN_CELL))).otherwise(F.lit(False))


def _composed(fixed: Column, value: Column, window) -> tuple[Column, Column]:
    """Running composition of steps that set the state to `value` (fixed) or, if not fixed, swap it where value is 1:
    (whether the state is known without the start, the state or the parity of swaps so far)."""
    swaps = F.sum(F.when(fixed, 0).otherwise(value)).over(window)
    return swaps, F.last(F.when(fixed, value), ignorenulls=True).over(window)


def records(spark: SparkSession, files: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(records, unclosed): records as f, b, name, r, text in file order, header lines included; and the path f of each
    file whose last quote is never closed, none of whose records is returned."""
    lines = _lines(spark, files)
    from_outside, from_inside = _left_open(F.col("text")), _left_open(F.concat(F.lit('"'), F.col("text")))
    steps = (lines.withColumn("o", from_outside).withColumn("i", from_inside)
             .withColumn("fixed", F.col("o") == F.col("i")).withColumn("value", F.col("o").cast("int")).drop("o", "i"))
    here = Window.partitionBy("f", "b").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    swaps, last = _composed(F.col("fixed"), F.col("value"), here)
    at_last = F.last(F.when(F.col("fixed"), F.col("swaps")), ignorenulls=True).over(here)
    after = (steps.withColumn("swaps", swaps).withColumn("last", last).withColumn("at_last", at_last)
             .withColumn("known", F.col("last").isNotNull())
             .withColumn("state", F.when(F.col("known"), (F.col("last") + F.col("swaps") - F.col("at_last")) % 2).otherwise(F.col("swaps") % 2))
             .select("f", "b", "name", "r", "text", "known", "state"))
    # one row per block of these files
    ends = after.groupBy("f", "b").agg(F.max_by(F.struct("known", "state"), "r").alias("end")).select("f", "b", "end.known", "end.state")
    along = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    swaps, last = _composed(F.col("known"), F.col("state"), along)
    at_last = F.last(F.when(F.col("known"), F.col("swaps")), ignorenulls=True).over(along)
    blocks = (ends.withColumn("swaps", swaps).withColumn("last", last).withColumn("at_last", at_last)
              .withColumn("end", F.when(F.col("last").isNotNull(), (F.col("last") + F.col("swaps") - F.col("at_last")) % 2).otherwise(F.col("swaps") % 2))
              .withColumn("start", F.lag("end", 1, 0).over(Window.partitionBy("f").orderBy("b")))
              .withColumn("open", F.last("end").over(Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
              .select("f", "b", "start", "open"))
    unclosed = blocks.where(F.col("open") == 1).select("f").distinct()
    stated = after.join(blocks.where(F.col("open") == 0).select("f", "b", "start"), ["f", "b"])
    ends_in = F.when(F.col("known"), F.col("state")).otherwise((F.col("start") + F.col("state")) % 2)
    order = Window.partitionBy("f", "b").orderBy("r")
    numbered = (stated.withColumn("inside", ends_in).withColumn("begins", F.coalesce(F.lag("inside").over(order), F.col("start")) == 0)
                .withColumn("number", F.sum(F.col("begins").cast("int")).over(here)))
    text = lambda of: F.array_join(F.transform(F.array_sort(F.collect_list(of)), lambda x: x["text"]), "\n")
    pieces = (numbered.groupBy("f", "b", "name", "number")
              .agg(F.min("r").alias("r"), F.max_by("inside", "r").alias("inside"), text(F.struct("r", "text")).alias("text")))
    whole = (F.col("number") > 0) & (F.col("inside") == 0)
    # at most two pieces per block belong to records that cross its ends
    group = F.sum((F.col("number") > 0).cast("int")).over(Window.partitionBy("f").orderBy("b", "number"))
    crossing = (pieces.where(~whole).withColumn("group", group).groupBy("f", "name", "group")
                .agg(F.min(F.struct("b", "r")).alias("at"), text(F.struct("b", "r", "text")).alias("text"))
                .select("f", "at.b", "name", "at.r", "text"))
    return pieces.where(whole).select("f", "b", "name", "r", "text").unionByName(crossing), unclosed
