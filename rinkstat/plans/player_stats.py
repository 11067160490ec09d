"""Player aggregates computed from the base tables with eager aggregation.

Every aggregate key except ``teamAbbrev``/``teamFullName``/``homeRoadFlag``
comes from the player dimension, so game rows can be reduced to the grain
``(playerId, teamAbbrev[, homeRoadFlag])`` *before* the dimension joins.  The
fact table is then shuffled once, map-side combined, and only the small
partial aggregate is joined and re-aggregated:

  games --partial agg--> (player, team, flag) partials
        --join distinct players of the position, teams--> --times their copies-->

Equal dimension rows are folded into one and counted before the join, and a
partial's sums are multiplied by that count, so the result equals aggregating
the joined mart row by row, even when the dimension holds a key twice (each
copy receives the same partial, as each copy would receive the same game
rows).  The wide joined rows are aggregated no more: a task holds narrow
partials only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import full_name, toi_seconds
from ..operators.filters import by_exact_name, by_kind
from ..operators.joins import left_join_dimension, role_playing_join
from ..schemas import AGG_KEYS, ALL_MEASURES, CARD_KEYS, GOALIE_SUMS, SKATER_SUMS

PLAYER_GRAIN = ["playerId", "teamAbbrev", "homeRoadFlag"]
CARD_GRAIN = ["playerId", "teamAbbrev"]


def game_partials(games: DataFrame, grain: Sequence[str] = PLAYER_GRAIN) -> DataFrame:
    """Per-grain game count and measure sums (``toi`` in seconds)."""
    measures = [m for m in ALL_MEASURES if m in games.columns] + ["toi"]
    g = games.withColumn("toi", toi_seconds("toi"))
    return g.groupBy(*grain).agg(
        F.count("gameId").alias("gamesCNT"), *[F.sum(m).alias(m) for m in measures]
    )


def _dimensioned(partials: DataFrame, players: DataFrame, teams: DataFrame, kind: str, keys: Sequence[str]) -> DataFrame:
    """One row per partial and distinct dimension attributes; ``_times`` is how often the joined rows would hold it.

    Equal dimension rows are folded before the join, so that the wide rows
    after it need no aggregate: they are unique already.
    """
    named = by_kind(players.withColumn("playersFIO", full_name("firstName", "lastName")), kind)
    attributes = [c for c in named.columns if c in keys]
    roster = named.groupBy(*attributes).agg(F.count(F.lit(1)).alias("_players"))
    names = teams.groupBy("triCode", "fullName").agg(F.count(F.lit(1)).alias("_n"))
    names = names.select("triCode", F.struct("fullName", "_n").alias("_team"))
    out = left_join_dimension(partials, roster, "playerId").filter(F.col("_players").isNotNull())
    out = role_playing_join(out, names, "triCode", "_team", {"teamAbbrev": "_played", "triCodeCurrent": "_current"})
    times = F.col("_players") * F.coalesce(F.col("_played._n"), F.lit(1)) * F.coalesce(F.col("_current._n"), F.lit(1))
    return out.withColumns({
        "teamFullName": F.col("_played.fullName"), "currentTeamFullName": F.col("_current.fullName"), "_times": times,
    })


def player_aggregate(
    games: DataFrame,
    players: DataFrame,
    teams: DataFrame,
    kind: str,
    keys: Sequence[str] = AGG_KEYS,
    name: str | None = None,
    pre_aggregated: bool = False,
) -> DataFrame:
    """Skater or goalie aggregate (as :func:`operators.aggregates.skater_aggregate`
    over the mart) computed from the base tables.

    ``pre_aggregated=True`` means ``games`` already holds :func:`game_partials`
    at a grain that includes the grain these keys need.
    """
    if name is not None:  # a lookup reads the games of the players of that name only
        players = by_exact_name(players.withColumn("playersFIO", full_name("firstName", "lastName")), name).drop("playersFIO")
        games = games.join(players.select("playerId").distinct(), "playerId", "left_semi")
    grain = PLAYER_GRAIN if "homeRoadFlag" in keys else CARD_GRAIN
    sums = SKATER_SUMS if kind == "skater" else GOALIE_SUMS
    if pre_aggregated:  # dealt by player, as the join needs them
        partials = games.repartition("playerId").groupBy(*grain).agg(*[F.sum(m).alias(m) for m in ("gamesCNT", *sums)])
    else:
        partials = game_partials(games, grain)
    rows = _dimensioned(partials, players, teams, kind, keys)
    return rows.select(*keys, *[(F.col(m) * F.col("_times")).cast("bigint").alias(m) for m in ("gamesCNT", *sums)])


def skater_aggregate_from_tables(games, players, teams):
    return player_aggregate(games, players, teams, "skater")


def goalie_aggregate_from_tables(games, players, teams):
    return player_aggregate(games, players, teams, "goalie")


def card_aggregate(
    games: DataFrame, players: DataFrame, teams: DataFrame, kind: str, name: str | None = None
) -> DataFrame:
    """The card grain directly (home and road folded, NULL-key groups
    dropped, all-NULL sums 0) — equal to ``rollup_home_road`` over the
    aggregate, with one shuffle fewer."""
    agg = player_aggregate(games, players, teams, kind, CARD_KEYS, name)
    measures = [c for c in agg.columns if c not in CARD_KEYS]
    return agg.dropna(subset=list(CARD_KEYS)).select(
        *CARD_KEYS, *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in measures]
    )
