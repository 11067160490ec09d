"""Declared schemas for landed payloads and warehouse tables.

Payloads are always read with an explicit schema: no inference, gaps become
NULL (never NaN or the text "nan"), and a malformed document is isolated in the
corrupt-record column instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# A localised text value is normally an object with a "default" entry, but may
# lack it or be a plain string.  VARIANT keeps any of these without flagging
# the whole document as corrupt (a STRUCT field would).
LOCALIZED = T.VariantType()

SKATER_MEASURES = [
    "goals",
    "points",
    "plusMinus",
    "powerPlayGoals",
    "powerPlayPoints",
    "gameWinningGoals",
    "otGoals",
    "shots",
    "shifts",
    "shorthandedGoals",
    "pim",
]

GOALIE_MEASURES = [
    "goals",
    "points",
    "gamesStarted",
    "shotsAgainst",
    "goalsAgainst",
    "shutouts",
    "pim",
]

ALL_MEASURES = list(dict.fromkeys(SKATER_MEASURES + GOALIE_MEASURES))

# Fixed values of the table contract: the sums of the two aggregates in output
# order (toi in seconds), their 14 keys and the card keys.
SKATER_SUMS = [
    "goals", "points", "plusMinus", "powerPlayGoals", "powerPlayPoints", "gameWinningGoals", "otGoals", "shots",
    "shifts", "shorthandedGoals", "toi", "pim",
]
GOALIE_SUMS = ["goals", "points", "gamesStarted", "shotsAgainst", "goalsAgainst", "shutouts", "toi", "pim"]

# Grain of both aggregates: player attributes, team played for, home/road.
AGG_KEYS = [
    "playerId",
    "headshot",
    "playersFIO",
    "triCodeCurrent",
    "currentTeamFullName",
    "teamAbbrev",
    "teamFullName",
    "homeRoadFlag",
    "birthDate",
    "birthCity",
    "birthCountry",
    "birthStateProvince",
    "positionCode",
    "shootsCatches",
]

# Grain of the player card: the aggregate keys without home/road, in the order
# the card query sorts them when a name has several rows.
CARD_KEYS = [
    "playerId",
    "playersFIO",
    "triCodeCurrent",
    "currentTeamFullName",
    "headshot",
    "teamAbbrev",
    "teamFullName",
    "birthDate",
    "birthCity",
    "shootsCatches",
    "birthCountry",
    "birthStateProvince",
    "positionCode",
]

TEAM_RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("fullName", T.StringType()),
        T.StructField("triCode", T.StringType()),
    ]
)
TEAMS_PAYLOAD = T.StructType([T.StructField("data", T.ArrayType(TEAM_RECORD))])

ROSTER_PLAYER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("headshot", T.StringType()),
        T.StructField("firstName", LOCALIZED),
        T.StructField("lastName", LOCALIZED),
        T.StructField("positionCode", T.StringType()),
        T.StructField("shootsCatches", T.StringType()),
        T.StructField("birthDate", T.StringType()),
        T.StructField("birthCity", LOCALIZED),
        T.StructField("birthCountry", T.StringType()),
        T.StructField("birthStateProvince", LOCALIZED),
    ]
)
# Keys are position groups ("forwards", "defensemen", "goalies", ...).
ROSTER_PAYLOAD = T.MapType(T.StringType(), T.ArrayType(ROSTER_PLAYER))

GAME_LOG_ENTRY = T.StructType(
    [
        T.StructField("gameId", T.LongType()),
        T.StructField("teamAbbrev", T.StringType()),
        T.StructField("opponentAbbrev", T.StringType()),
        T.StructField("homeRoadFlag", T.StringType()),
        T.StructField("commonName", LOCALIZED),
        T.StructField("opponentCommonName", LOCALIZED),
        T.StructField("toi", T.StringType()),
    ]
    + [T.StructField(m, T.IntegerType()) for m in ALL_MEASURES]
)
GAME_LOG_PAYLOAD = T.StructType([T.StructField("gameLog", T.ArrayType(GAME_LOG_ENTRY))])


def game_log_payload(game_id_type: T.DataType) -> T.StructType:
    """The game-log payload with another type for ``gameId`` (e.g. quoted ids)."""
    fields = [
        T.StructField("gameId", game_id_type) if f.name == "gameId" else f
        for f in GAME_LOG_ENTRY.fields
    ]
    return T.StructType([T.StructField("gameLog", T.ArrayType(T.StructType(fields)))])

SIDE = T.StructType(
    [T.StructField("name", LOCALIZED), T.StructField("score", T.IntegerType())]
)
GAME = T.StructType([T.StructField("awayTeam", SIDE), T.StructField("homeTeam", SIDE)])
GAME_DAY = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("games", T.ArrayType(GAME))]
)
SCOREBOARD_PAYLOAD = T.StructType([T.StructField("gamesByDate", T.ArrayType(GAME_DAY))])

TEAMS_TABLE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("fullName", T.StringType()),
        T.StructField("triCode", T.StringType()),
    ]
)

PLAYERS_INFO_TABLE = T.StructType(
    [
        T.StructField("playerId", T.LongType()),
        T.StructField("headshot", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("positionCode", T.StringType()),
        T.StructField("shootsCatches", T.StringType()),
        T.StructField("birthDate", T.DateType()),
        T.StructField("birthCity", T.StringType()),
        T.StructField("birthCountry", T.StringType()),
        T.StructField("birthStateProvince", T.StringType()),
        T.StructField("triCodeCurrent", T.StringType()),
        T.StructField("updatedDt", T.StringType()),
    ]
)

GAMES_INFO_TABLE = T.StructType(
    [
        T.StructField("playerId", T.LongType()),
        T.StructField("gameId", T.LongType()),
        T.StructField("teamAbbrev", T.StringType()),
        T.StructField("opponentAbbrev", T.StringType()),
        T.StructField("homeRoadFlag", T.StringType()),
        T.StructField("toi", T.StringType()),
    ]
    + [T.StructField(m, T.IntegerType()) for m in ALL_MEASURES]
)

SCHEDULE_TABLE = T.StructType(
    [
        T.StructField("away_teams", T.StringType()),
        T.StructField("home_teams", T.StringType()),
        T.StructField("away_result", T.IntegerType()),
        T.StructField("home_result", T.IntegerType()),
        T.StructField("date_play", T.StringType()),
    ]
)
