"""Ordered-row operators without a global or per-key window.

A window partitioned by a hot key puts the whole key in one task, and an
unpartitioned window puts the whole table in one task.  Each operator here is
instead a partial aggregate (one small row per group) joined back, or an
aggregate of a struct whose natural ordering is the requested order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def take_while(
    df: DataFrame,
    scope: Sequence[str],
    order: str,
    keep: Column,
) -> DataFrame:
    """Within each ``scope`` group, keep rows in ``order`` up to (excluding)
    the first row where ``keep`` is false; later rows of that group are dropped
    even if ``keep`` holds for them again.

    The cut point is ``min(order)`` over failing rows: an aggregate with a
    map-side phase, one row per group, joined back on the scope keys.
    """
    cuts = (
        df.filter(~keep | keep.isNull())
        .groupBy(*scope)
        .agg(F.min(order).alias("_cut"))
    )
    joined = df.join(cuts, on=list(scope), how="left")
    return joined.filter(F.col("_cut").isNull() | (F.col(order) < F.col("_cut"))).drop("_cut")


def first_row_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """One row per ``group``: the first in ascending ``order`` (NULLs first).

    ``min`` over a struct compares field by field, so ``min(struct(order...,
    rest...))`` is the first row in that order; being an aggregate it combines
    map-side and never gathers a whole group in one task.
    """
    group = list(group)
    order = [c for c in order if c not in group]
    rest = [c for c in df.columns if c not in group and c not in order]
    first = df.groupBy(*group).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*group, "_first.*").select(*df.columns)


def change_marks(
    df: DataFrame,
    partition: Sequence[str],
    block: Sequence[str],
    within: Sequence[str],
    mark: str = "new_block",
) -> DataFrame:
    """Mark the first row of each ``block`` except the first block, per ``partition``.

    With rows ordered by ``partition, block, within``, a row's block differs
    from the previous row's exactly when it is its block's first row and the
    block is not the partition's first.  Both facts come from minima (partial
    aggregates, one small row per block / partition) joined back, so neither a
    global ``lag`` window nor a per-partition window is needed.
    """
    partition, block, within = list(partition), list(block), list(within)
    firsts = df.groupBy(*partition, *block).agg(F.min(F.struct(*within)).alias("_first_row"))
    first_blocks = firsts.groupBy(*partition).agg(F.min(F.struct(*block)).alias("_first_block"))
    out = df.join(firsts, on=partition + block, how="left")
    if partition:
        out = out.join(first_blocks, on=partition, how="left")
        first_block = F.col("_first_block")
    else:
        first_block = first_blocks.select("_first_block").scalar()
    starts = (F.struct(*within) == F.col("_first_row")) & (F.struct(*block) != first_block)
    return out.withColumn(mark, starts).drop("_first_row", "_first_block")


def sort_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.orderBy(*columns)


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows in a deterministic order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)
