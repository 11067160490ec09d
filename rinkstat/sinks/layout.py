"""Table layouts that let a reader skip files: Bloom filters on names, and two keys clustered at once.

Both only arrange how a snapshot is written; any Parquet reader gets the same
rows, and Spark's own filter pushdown does the skipping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parquet import write_snapshot

#: Quantile cuts per clustered column are two to the power of this.
BITS = 6


def bloom_options(columns: Sequence[str], distinct_per_file: int) -> dict[str, str]:
    """Writer options for a Bloom filter on each of ``columns``, sized for that many distinct values a file.

    Their dictionaries are off: of a chunk that is all dictionary no Bloom filter
    is written, and one of nearly unique names is as large as the names.
    """
    out = {}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct_per_file)
        out[f"parquet.enable.dictionary#{c}"] = "false"
    return out


def write_for_lookup(df: DataFrame, path: str, columns: Sequence[str], distinct_per_file: int = 1_000_000) -> None:
    """Replace the table at ``path`` by ``df`` with Bloom filters on ``columns``, in whatever order its rows are.

    A lookup by equality skips the row groups that surely lack the value, though
    their smallest and greatest values span it.  NULLs are in no filter and are found by scans only.
    """
    write_snapshot(df, path, options=bloom_options(columns, distinct_per_file))


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """``2 ** bits - 1`` approximate quantiles of each numeric column: one row of fixed size, whatever the table's."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[i] or [])) for i, c in enumerate(columns)}


def part_of(column: str, cuts: Sequence) -> Column:
    """How many of ``cuts`` lie below the value, 0 for NULL: a binary search in nested conditions."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(column) > F.lit(cuts[mid]), search(mid + 1, high)).otherwise(search(low, mid))

    return search(0, len(cuts))


def interleaved(parts: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several numbers of ``bits`` bits taken in turn, the first number's highest bit first."""
    cell, n = F.lit(0).cast("long"), len(parts)
    for i, part in enumerate(parts):
        for b in range(bits):
            bit = F.shiftright(part.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            cell = cell.bitwiseOR(F.shiftleft(bit, b * n + n - 1 - i))
    return cell


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], num_files: int | None = None, bits: int = BITS) -> None:
    """Replace the table at ``path`` by ``df``, clustered on all of the numeric ``columns`` alike.

    Rows go to files by ranges of their interleaved quantile numbers, so a file
    holds a small box of each column's values and a filter on any one of them
    skips most files.  Cuts follow the data: a value that holds a third of all
    rows is split by the other columns.  NULLs lie with the smallest values.
    """
    cuts = quantile_cuts(df, columns, bits)
    cell = interleaved([part_of(c, cuts[c]) for c in columns], bits)
    order = [cell, *[F.col(c) for c in columns]]
    placed = df.repartitionByRange(num_files, *order) if num_files else df.repartitionByRange(*order)
    write_snapshot(placed.sortWithinPartitions(*order), path)
