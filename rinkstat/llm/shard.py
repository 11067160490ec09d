"""Sharding by a Feistel permutation over global row numbers.

Rows are numbered by a total order of their key columns; a keyed permutation
of those numbers gives each row its place in a global shuffle.  The place alone
tells shard (place modulo shards) and slot (place divided by shards), so any
row's position can be computed from its number without the other rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shielded, stored

#: Multiplier, addend of each Feistel round; values modulo 2**31 - 1 keep products within 63 bits.
ROUND_KEYS = (
    (48271, 11), (69621, 1013), (16807, 7919), (39373, 104729), (45742, 15485863), (43219, 32452843),
)
PRIME = (1 << 31) - 1


def permute(x: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Where each number of ``0 .. n - 1`` goes.

    The Feistel network works on pairs below ``ceil(sqrt(n))``; a result outside
    ``0 .. n - 1`` walks its cycle on until it is inside.
    """
    side = np.int64(isqrt(n - 1) + 1 if n > 1 else 1)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v // side, v % side
        for factor, addend in ROUND_KEYS:
            left, right = right, (left + ((right % PRIME) * factor + addend + seed) % PRIME) % side
        return left * side + right

    out = once(x.astype(np.int64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out


def numbered(df: DataFrame, order: list[str], rows_per_range: int = 10_000_000) -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` (0 .. n - 1 in the order of ``order``, NULLs first) and the number of rows.

    The rows are dealt into ranges of the order, stored with their range's
    number, and counted per range; only one count per range is summed up.  Give
    the numbering columns and what is small beside them: a range of rows is sorted in a task.
    Rows equal in all of ``order`` are interchangeable.
    """
    df, back = shielded(df)
    total = df.count()
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // rows_per_range))
    dealt = stored(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "row-ranges")
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = stored(counts.select("_range", before.alias("_start")), "range-starts")
    local = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return (
        back(
            dealt.withColumn("_local", local).join(starts, "_range")
            .withColumn("row_number", (F.col("_start") + F.col("_local")).cast("long"))
            .drop("_range", "_start", "_local")
        ),
        total,
    )


def feistel_shards(df: DataFrame, order: list[str], shards: int = 8, seed: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``; shard sizes differ by at most one.

    ``order`` must tell rows apart; rows equal in all of it are interchangeable
    and get different slots.  NULLs order first.  An empty table stays empty.
    Existing columns of these names are replaced, any others kept; those of
    ``order`` don't begin with ``_``.
    """
    rows, n = numbered(df.drop("row_number", "shard", "slot"), order)
    schema = T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = permute(batch.column("row_number").to_numpy(zero_copy_only=False), n, seed)
            columns = [*batch.columns, pa.array((at % shards).astype(np.int32)), pa.array(at // shards)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "shard", "slot"])

    return rows.mapInArrow(place, schema)
