"""Parquet table scans with projection and predicate pushdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def scan_parquet(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Read a parquet table; the projection and filter reach the scan
    (``ReadSchema`` / ``PushedFilters``), so only needed columns and row
    groups are read."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    if where is not None:
        df = df.filter(where)
    return df
