"""Row filters on player position and name.

Position filters follow SQL three-valued logic: a NULL position is neither a
goalie nor a skater, so it falls out of both aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the position code of a goalie.
GOALIE_CODE = "G"


def skaters(df: DataFrame, column: str = "positionCode") -> DataFrame:
    return df.filter(F.col(column) != F.lit(GOALIE_CODE))


def goalies(df: DataFrame, column: str = "positionCode") -> DataFrame:
    return df.filter(F.col(column) == F.lit(GOALIE_CODE))


def by_kind(df: DataFrame, kind: str, column: str = "positionCode") -> DataFrame:
    if kind == "goalie":
        return goalies(df, column)
    if kind == "skater":
        return skaters(df, column)
    raise ValueError(f"kind must be 'goalie' or 'skater', not {kind!r}")


def by_exact_name(df: DataFrame, name: str, column: str = "playersFIO") -> DataFrame:
    """Case- and space-sensitive equality; the empty name never matches."""
    return df.filter((F.col(column) == F.lit(name)) & (F.col(column) != F.lit("")))
