"""Operators on the order of one whole table: no partition key, no window over all rows.

The table is cut into ranges of its order and stored with the range's number.
Within a range rows see the rows before them; one summary row per range is
combined over the ranges before it, and what it carries is joined back.  A
block of equal values may span any number of ranges, and may come again later.

``order`` should be total; rows equal in it are taken in the order of their
block.  NULLs come first and equal NULLs.  An empty table stays empty, and
columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import scratch_dir


def _windows(*by: str, order: str) -> tuple[WindowSpec, WindowSpec]:
    """A window by ``by`` in ``order``, and the same up to the current row."""
    window = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return window, window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _in_ranges(df: DataFrame, order: Sequence[str], block: Sequence[str], fail: Column) -> DataFrame:
    """``(_row, _block, _fail, _at, _range)``, stored: range numbers ascend with the order and don't change on a retry."""
    packed = df.select(
        F.struct("*").alias("_row"), F.struct(*block).alias("_block"), fail.alias("_fail"),
        F.struct(*order, F.struct(*block).alias("_block"), fail.alias("_fail")).alias("_at"),
    )
    path = scratch_dir(df.sparkSession, "ranges")
    packed.repartitionByRange("_at").withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _changed(before: str, now: str) -> Column:
    return ~F.col(before).eqNullSafe(F.col(now))


def change_marks_ordered(df: DataFrame, order: Sequence[str], block: Sequence[str], mark: str = "new_block") -> DataFrame:
    """``df`` with ``mark``: the row's ``block`` differs from that of the row before it; false for the first row."""
    placed = _in_ranges(df, order, block, F.lit(False))
    within, _ = _windows("_range", order="_at")
    ranges, _ = _windows(order="_range")  # over the summaries: one row per range
    last = placed.groupBy("_range").agg(F.max_by("_block", "_at").alias("_last"))
    carried = last.select("_range", F.lag("_last").over(ranges).alias("_carried"))
    local = placed.select(
        "_row", "_range", "_block", F.lag("_block").over(within).alias("_before"), F.row_number().over(within).alias("_n")
    )
    first = F.col("_n") == 1
    marked = F.when(first & F.col("_carried").isNull(), False).when(first, _changed("_carried", "_block")).otherwise(
        _changed("_before", "_block")
    )
    return local.join(carried, "_range").select("_row.*", marked.alias(mark))


def take_while_ordered(df: DataFrame, order: Sequence[str], block: Sequence[str], keep: Column) -> DataFrame:
    """Of each run of rows of one ``block`` those before its first row for which ``keep`` isn't true."""
    placed = _in_ranges(df, order, block, ~F.coalesce(keep, F.lit(False)))
    within, running = _windows("_range", order="_at")
    ranges, ranges_so_far = _windows(order="_range")  # over the summaries: one row per range
    numbered = placed.withColumn("_n", F.row_number().over(within)).withColumn("_before", F.lag("_block").over(within))
    starts = (F.col("_n") > 1) & _changed("_before", "_block")
    # Where the row's run starts (NULL: before this range, or with it) and the last failing row.
    local = numbered.withColumn("_start", F.max(F.when(starts, F.col("_n"))).over(running)).withColumn(
        "_failed", F.max(F.when(F.col("_fail"), F.col("_n"))).over(running)
    )
    ends = local.groupBy("_range").agg(
        F.min_by("_block", "_n").alias("_first"), F.max_by(F.struct("_block", "_start", "_failed"), "_n").alias("_end")
    ).select("_range", "_first", "_end.*")
    resets = F.col("_start").isNotNull() | F.col("_prior").isNull() | _changed("_prior", "_first")
    tail_failed = F.col("_failed") >= F.coalesce("_start", F.lit(1))
    # A run that reaches a range's end has failed if it failed in any range since the one in which it began.
    state = ends.withColumn("_prior", F.lag("_block").over(ranges)).select(
        "_range", "_block",
        F.max(F.when(resets, F.col("_range"))).over(ranges_so_far).alias("_began"),
        F.max(F.when(tail_failed, F.col("_range"))).over(ranges_so_far).alias("_broke"),
    )
    after = F.struct("_block", F.coalesce(F.col("_broke") >= F.col("_began"), F.lit(False)).alias("failed"))
    carried = state.select("_range", F.lag(after).over(ranges).alias("_carried"))
    inherited = F.col("_carried._block").eqNullSafe(F.col("_block")) & F.col("_carried.failed")
    over = F.when(F.col("_start").isNotNull(), F.coalesce(F.col("_failed") >= F.col("_start"), F.lit(False))).otherwise(
        F.col("_failed").isNotNull() | inherited
    )
    return local.join(carried, "_range").filter(~F.coalesce(over, F.lit(False))).select("_row.*")
