"""Delimited files with line feeds inside quoted cells, read by many tasks per file.

Whether a line begins inside a quoted cell depends on all lines before it. Each line is therefore taken
both ways: where it ends if it begins outside of a cell, and where if it begins inside. Within a
block of a file these compose by a running window, over the blocks of a file by another one over
a row per block, and every line knows where it stands. A record is a line that begins outside and the
lines up to the next such line. Only lines of records with a line feed are shuffled to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postbud.session import stage

# A quote that is never closed would swallow the rest of its file, which no single task could hold.
MAX_RECORD_LINES = 100_000

BLOCK = ["_part", "_block"]


def ends_inside(line: Column, delimiter: str, begins_inside: bool) -> Column:
    """Whether a line ends within a quoted cell, given whether it begins within one.

    A quote opens a cell at its very beginning only. Within a cell two quotes are one character, a
    lone one closes it; whatever follows up to the delimiter belongs to the cell, quotes included.
    """
    start, outside, inside, maybe_closed = (F.lit(x) for x in (0, 1, 2, 3))

    def at_quote(state: Column, before: Column) -> Column:
        opens = F.when(before.endswith(delimiter), inside).otherwise(outside)
        return (
            F.when(state == inside, maybe_closed)
            .when((state == maybe_closed) & (before == ""), inside)
            .when((state == start) & (before == ""), inside)
            .otherwise(opens)
        )

    pieces = F.split(line, '"', -1)  # a quote stands after each but the last
    before_quotes = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    state = F.aggregate(before_quotes, inside if begins_inside else start, at_quote)
    without = F.lit(begins_inside)  # nothing changes in a line without a quote
    return F.when(F.contains(line, F.lit('"')), state == inside).otherwise(without)


def _carried(fixed: Column, value: Column, swaps: Column, before) -> tuple[Column, Column]:
    """State after all rows before this one: whether it is known, and it or how often it has changed."""
    last = F.last(F.when(fixed, F.struct(value.alias("value"), swaps.alias("swaps"))), ignorenulls=True).over(before)
    since = F.coalesce(F.sum(swaps.cast("int")).over(before), F.lit(0))
    at_last = F.last(F.when(fixed, F.col("_swaps_before")), ignorenulls=True).over(before)
    odd = (since - F.coalesce(at_last, F.lit(0))) % 2 == 1
    return last.isNotNull(), F.coalesce(last["value"], F.lit(False)) != odd


def _states(lines: DataFrame, within: list[str], order: str) -> DataFrame:
    """Adds ``_known`` and ``_state`` at the beginning of each row, from ``_from_out`` and ``_from_in``."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.col("_from_out") == F.col("_from_in")
    swaps = F.col("_from_out") & ~F.col("_from_in")
    counted = lines.withColumn("_swaps_before", F.sum(swaps.cast("int")).over(upto))
    known, state = _carried(fixed, F.col("_from_out"), swaps, before)
    return counted.withColumns({"_known": known, "_state": state}).drop("_swaps_before")


def whole_records(lines: DataFrame, delimiter: str) -> DataFrame:
    """``_uri, _part, _block, _i, line``: a row per record, where it begins.

    ``lines`` holds every line of the files with ``_part``, ``_block`` (offset of the block) and ``_i`` (order
    within it); it must be a written table, so that the order is the same whenever it is read.
    """
    line = F.col("line")
    both = lines.withColumns(
        {"_from_out": ends_inside(line, delimiter, False), "_from_in": ends_inside(line, delimiter, True)}
    )
    placed = stage(_states(both, BLOCK, "_i"), "quoted_lines")

    # A row per block: what it does to the state as a whole, and where its last record may begin.
    def after(begins_inside: bool) -> Column:
        begin = F.col("_state") != (~F.col("_known") & F.lit(begins_inside))
        return F.when(begin, F.col("_from_in")).otherwise(F.col("_from_out"))

    def begins(begins_inside: bool) -> Column:
        return F.when(~(F.col("_state") != (~F.col("_known") & F.lit(begins_inside))), F.col("_i"))

    last = F.max(F.struct("_i", after(False).alias("out"), after(True).alias("inn")))
    blocks = placed.groupBy(*BLOCK).agg(
        last.alias("last"), F.max(begins(False)).alias("start_out"), F.max(begins(True)).alias("start_in")
    )
    blocks = blocks.select(
        *BLOCK, F.col("last.out").alias("_from_out"), F.col("last.inn").alias("_from_in"), "start_out", "start_in"
    )
    blocks = _states(blocks, ["_part"], "_block").withColumn(
        "_start", F.when(F.col("_state"), F.col("start_in")).otherwise(F.col("start_out"))
    )
    earlier = Window.partitionBy("_part").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    open_record = F.when(F.col("_start").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("_start").alias("i")))
    blocks = blocks.select(
        *BLOCK, F.col("_state").alias("_block_inside"), F.last(open_record, ignorenulls=True).over(earlier).alias("_open")
    )
    # A row per block of 128 MB; which way it is joined is left to Spark, which sees its size.
    lines = placed.join(stage(blocks, "quoted_blocks"), BLOCK)
    inside = F.col("_state") != (~F.col("_known") & F.col("_block_inside"))
    starts = ~inside
    goes_on = F.when(inside, F.col("_from_in")).otherwise(F.col("_from_out"))
    upto = Window.partitionBy(*BLOCK).orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.struct(F.col("_block").alias("block"), F.col("_i").alias("i"))
    lines = lines.withColumns({"_starts": starts, "_goes_on": goes_on}).withColumn(
        "_record", F.coalesce(F.last(F.when(F.col("_starts"), here), ignorenulls=True).over(upto), F.col("_open"))
    )
    lines = stage(lines.select("_uri", *BLOCK, "_i", "line", "_starts", "_goes_on", "_record"), "quoted_records")

    alone = lines.where("_starts AND NOT _goes_on").select("_uri", *BLOCK, "_i", "line")
    parts = lines.where("NOT (_starts AND NOT _goes_on)").groupBy("_uri", "_part", "_record")
    sizes = parts.agg(F.count("*").alias("n")).where(F.col("n") > MAX_RECORD_LINES)
    unclosed = sizes.select("_part").first()
    if unclosed is not None:
        raise ValueError(f"a quoted cell goes on for more than {MAX_RECORD_LINES} lines in {unclosed[0]}")
    ordered = F.array_sort(F.collect_list(F.struct("_block", "_i", "line")))
    joined = parts.agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("line")).select(
        "_uri", "_part", F.col("_record.block").alias("_block"), F.col("_record.i").alias("_i"), "line"
    )
    return alone.unionByName(joined)
