"""Player aggregates over the player-game mart.

All are hash aggregates with a partial (map-side) phase, so the shuffle carries
one row per group per map task and a group holding a third of the rows costs
no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import toi_seconds
from ..schemas import AGG_KEYS, CARD_KEYS, GOALIE_SUMS, SKATER_SUMS
from .filters import goalies, skaters


def _player_aggregate(mart: DataFrame, sums: Sequence[str], keys: Sequence[str]) -> DataFrame:
    with_seconds = mart.withColumn("toi", toi_seconds("toi"))
    return with_seconds.groupBy(*keys).agg(
        F.count("gameId").alias("gamesCNT"),
        *[F.sum(m).cast("bigint").alias(m) for m in sums],
    )


def skater_aggregate(mart: DataFrame, keys: Sequence[str] = AGG_KEYS) -> DataFrame:
    """Non-goalies (NULL position excluded) per player, team and home/road."""
    return _player_aggregate(skaters(mart), SKATER_SUMS, keys)


def goalie_aggregate(mart: DataFrame, keys: Sequence[str] = AGG_KEYS) -> DataFrame:
    return _player_aggregate(goalies(mart), GOALIE_SUMS, keys)


def rollup_home_road(agg: DataFrame, keys: Sequence[str] = CARD_KEYS) -> DataFrame:
    """Fold home and road rows together on the remaining keys.

    Groups with any NULL key are dropped and an all-NULL sum reports 0: the
    regrouping rules of the card query, written out explicitly.
    """
    measures = [c for c in agg.columns if c not in keys and c != "homeRoadFlag"]
    complete = agg.dropna(subset=list(keys))
    return complete.groupBy(*keys).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in measures]
    )


def count_non_null(df: DataFrame, column: str, keys: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    out = alias or f"{column}_count"
    return df.groupBy(*keys).agg(F.count(column).alias(out))
