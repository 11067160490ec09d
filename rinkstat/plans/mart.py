"""The denormalised player-game mart: one row per game-log row, with the
player's attributes and three team names (played for, opponent, current)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scalar import full_name
from ..operators.joins import left_join_dimension, role_playing_join

TEAM_ROLES = {
    "teamAbbrev": "teamFullName",
    "opponentAbbrev": "opponentFullName",
    "triCodeCurrent": "currentTeamFullName",
}


def player_game_mart(games: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """games ⟕ players (playerId) ⟕ teams ×3 roles, plus ``playersFIO``.

    A game whose player is missing from the dimension keeps NULL attributes
    and the empty name ``""``; a team code missing from ``teams`` gives a NULL
    team name.  The player join shuffles on ``playerId`` (AQE splits a hot
    player); the team joins broadcast when ``teams`` is under the size
    threshold and reuse one exchange for the three roles.
    """
    out = left_join_dimension(games, players, "playerId")
    out = role_playing_join(out, teams, "triCode", "fullName", TEAM_ROLES)
    out = out.withColumn("playersFIO", full_name("firstName", "lastName"))
    return out.drop("firstName", "lastName")
