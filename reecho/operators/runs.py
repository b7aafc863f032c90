"""Running totals and runs over an ordered stream, without one task per stream.

Offsets are cut into chunks of fixed width. A chunk is summarised where it lies; summaries are merged ``FAN`` at a time, level upon
level, and what stands before each is handed down again. No task meets more than a chunk's rows or ``FAN`` summaries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK_WIDTH = 65536
FAN = 4096
# 2**16 rows a chunk and 2**12 summaries a level reach over offsets of 63 bits
LEVELS = 4


def _over_levels(
    chunks: DataFrame, part: str, merge: Callable[[DataFrame, W], tuple[DataFrame, DataFrame]], place: Callable[[Column], Column], fan: int, level: int = 1
) -> DataFrame:
    """``(part, chunk, before)``: what stands before each summary.

    ``merge(rows, in_order)`` adds ``inner`` to summaries that stand in one window, what stands before them there, and aggregates
    these windows. ``place`` combines what stands before a window, null for the first, with ``inner``.
    """
    above = F.floor(F.col("chunk") / fan).cast("bigint") if level < LEVELS else F.lit(0).cast("bigint")
    rows = chunks.withColumn("above", above)
    placed, merged = merge(rows, W.partitionBy(part, "above").orderBy("chunk"))
    if level == LEVELS:
        return placed.select(part, "chunk", place(F.lit(None)).alias("before"))
    over = _over_levels(merged.withColumnRenamed("above", "chunk"), part, merge, place, fan, level + 1)
    met = placed.join(over.select(part, F.col("chunk").alias("above"), F.col("before").alias("outer")), [part, "above"])
    return met.select(part, "chunk", place(F.col("outer")).alias("before"))


def running_total(
    rows: DataFrame, part: str, offset: str, value: str, out: str, chunk_width: int = CHUNK_WIDTH, fan: int = FAN
) -> DataFrame:
    """Adds the sum of ``value`` up to and including each row, per ``part`` by ``offset``.

    Offsets are unique integers within a part, so a chunk holds at most ``chunk_width`` rows.
    """
    chunked = rows.withColumn("chunk", F.floor(F.col(offset) / chunk_width))
    upto = W.partitionBy(part, "chunk").orderBy(offset).rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = chunked.withColumn("inner_total", F.sum(value).over(upto))

    def merge(summaries: DataFrame, in_order: W) -> tuple[DataFrame, DataFrame]:
        before = F.sum("total").over(in_order.rowsBetween(W.unboundedPreceding, -1))
        placed = summaries.withColumn("inner", F.coalesce(before, F.lit(0)))
        return placed, summaries.groupBy(part, "above").agg(F.sum("total").alias("total"))

    totals = chunked.groupBy(part, "chunk").agg(F.sum(value).alias("total"))
    carried = _over_levels(totals, part, merge, lambda outer: F.coalesce(outer, F.lit(0)) + F.col("inner"), fan)
    joined = inner.join(carried, [part, "chunk"])
    return joined.withColumn(out, F.col("inner_total") + F.col("before")).drop("chunk", "inner_total", "before")


def author_runs(
    messages: DataFrame, part: str = "part", offset: str = "offset", author: str = "user_id", chunk_width: int = CHUNK_WIDTH, fan: int = FAN
) -> DataFrame:
    """Adds ``run_id``: 1, 2, ... for the runs of consecutive messages by one author in a part.

    A summary holds its first and last author and how often the author changes inside. What stands before it is
    the last author there and the number of runs so far.
    """
    chunked = messages.withColumn("chunk", F.floor(F.col(offset) / chunk_width))
    in_order = W.partitionBy(part, "chunk").orderBy(offset)
    upto = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    switched = (F.row_number().over(in_order) > 1) & ~F.lag(author).over(in_order).eqNullSafe(F.col(author))
    flagged = chunked.withColumn("switched", switched.cast("bigint"))
    numbered = flagged.withColumn("switches", F.sum("switched").over(upto))
    chunks = flagged.groupBy(part, "chunk").agg(
        F.min_by(author, offset).alias("first"), F.max_by(author, offset).alias("last"), F.sum("switched").alias("switches")
    )

    def merge(summaries: DataFrame, in_order: W) -> tuple[DataFrame, DataFrame]:
        later = F.row_number().over(in_order) > 1
        opens = (later & ~F.lag("last").over(in_order).eqNullSafe(F.col("first"))).cast("bigint")
        opened = summaries.withColumn("opens", opens)
        before = F.sum(F.col("opens") + F.col("switches")).over(in_order.rowsBetween(W.unboundedPreceding, -1))
        # run of the summary's first message, counted from that of the window's first
        placed = opened.withColumn("inner", F.coalesce(before, F.lit(0)) + F.col("opens"))
        merged = opened.groupBy(part, "above").agg(
            F.min_by("first", "chunk").alias("first"), F.max_by("last", "chunk").alias("last"),
            F.sum(F.col("opens") + F.col("switches")).alias("switches"),
        )
        return placed, merged

    starts = _over_levels(chunks, part, merge, lambda outer: F.coalesce(outer, F.lit(1)) + F.col("inner"), fan)
    joined = numbered.join(starts, [part, "chunk"])
    return joined.withColumn("run_id", F.col("before") + F.col("switches")).drop("chunk", "switched", "switches", "before")


def scope_to_runs(messages: DataFrame, part: str = "part") -> DataFrame:
    """Replaces ``user_id`` by the run, so that matching stays inside runs."""
    return messages.withColumn("user_id", F.concat_ws("/", F.col(part).cast("string"), F.col("run_id").cast("string")))
