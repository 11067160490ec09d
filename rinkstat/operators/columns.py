"""Projection operators: subset, drop, rename, stamp."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop by name; names that are absent are ignored."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def stamp_run_date(df: DataFrame, ds: str, column: str = "updatedDt") -> DataFrame:
    """Add the run date (the scheduler's ``YYYY-MM-DD`` string) as a constant."""
    return df.withColumn(column, F.lit(ds))
