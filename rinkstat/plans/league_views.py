"""Driver tables reshaped into league tables (teams, players, games).

The driver's star schema has no league data, so each benchmark/correctness
query first maps it onto the league domain.  The derivations are SQL
expressions shared with the DuckDB oracle (:mod:`rinkstat.plans.oracle`), so
both engines compute the same inputs.  Every view reads whole tables: rows are
assigned to roles by attributes, never sampled.

  teams    <- nation                 (25 teams; codes T00..T24)
  players  <- part                   (in joins: every part whose type is not STANDARD,
                                      so games of STANDARD parts miss the dimension)
  games    <- lineitem x supplier    (one row per line: player = part,
                                      game = order, team = supplier's nation)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GAMES_INFO_TABLE, PLAYERS_INFO_TABLE

# Fixed values of the reshape (shared with the oracle).
RUN_DATE = "2024-01-01"
NEXT_RUN_DATE = "2024-01-02"
AS_OF = "2024-06-30"
OFF_ROSTER_TYPE = "STANDARD"
OLD_ROSTER_MAX_SIZE = 35  # day-1 roster: p_size <= 35
NEW_ROSTER_MIN_SIZE = 20  # day-2 roster: p_size >= 20
OLD_GAMES_BEFORE = "2000-01-01"  # day-1 game logs: shipped before
NEW_GAMES_FROM = "1998-01-01"  # day-2 game logs: shipped on or after
SOUGHT_NAME, SOUGHT_PLAYER, SOUGHT_GAME = "cold anvil", 77, 1000  # what the lookups ask for
BOARD_SIZE = 64  # orders per scoreboard document (o_orderkey div 64)


def team_code(expr: str) -> str:
    return f"('T' || lpad(CAST({expr} AS STRING), 2, '0'))"


TEAM_COLUMNS = {
    "id": "n_nationkey",
    "fullName": "n_name",
    "triCode": team_code("n_nationkey"),
}

PLAYER_COLUMNS = {
    "playerId": "p_partkey",
    "headshot": "('headshots/' || CAST(p_partkey AS STRING) || '.png')",
    "firstName": "split_part(p_name, ' ', 1)",
    "lastName": "split_part(p_name, ' ', 2)",
    "positionCode": "CASE p_type WHEN 'ECONOMY' THEN 'G' WHEN 'PROMO' THEN NULL ELSE 'C' END",
    "shootsCatches": "CASE WHEN p_size % 2 = 0 THEN 'L' ELSE 'R' END",
    "birthDate": "(DATE '1975-01-01' + CAST(p_partkey % 9000 AS INT))",
    "birthCity": "p_brand",
    "birthCountry": "p_type",
    "birthStateProvince": "CASE WHEN p_size > 40 THEN NULL ELSE 'P' || CAST(p_size % 5 AS STRING) END",
    "triCodeCurrent": team_code("p_size % 30"),
    "updatedDt": f"'{RUN_DATE}'",
}
PLAYER_FILTER = f"p_type <> '{OFF_ROSTER_TYPE}'"
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]

GAME_COLUMNS = {
    "playerId": "l_partkey",
    "gameId": "l_orderkey",
    "teamAbbrev": team_code("s_nationkey"),
    "opponentAbbrev": team_code("(s_nationkey + l_linenumber) % 25"),
    "homeRoadFlag": "CASE WHEN l_linestatus = 'O' THEN 'H' ELSE 'R' END",
    "toi": (
        "CASE WHEN l_quantity = 50 THEN '0:50:00' WHEN l_quantity = 49 AND l_linenumber = 7 THEN '99999999:00' ELSE "
        "CAST(CAST(l_quantity AS INT) AS STRING) || ':' || lpad(CAST(l_linenumber * 7 AS STRING), 2, '0') END"
    ),
    "goals": "l_linenumber - 1",
    "points": "l_linenumber - 1 + CAST(l_quantity AS INT) % 3",
    "plusMinus": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS INT) % 7 - 3 END",
    "powerPlayGoals": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "powerPlayPoints": "CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END",
    "gameWinningGoals": "CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END",
    "otGoals": "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END",
    "shots": "CAST(l_quantity AS INT)",
    "shifts": "10 + l_linenumber * 3",
    "shorthandedGoals": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 1 ELSE 0 END",
    "pim": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE (CAST(l_quantity AS INT) % 3) * 2 END",
    "gamesStarted": "CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END",
    "shotsAgainst": "CAST(l_quantity AS INT)",
    "goalsAgainst": "l_linenumber - 1",
    "shutouts": "CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END",
}
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _typed(df: DataFrame, columns: dict[str, str], schema) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[F.expr(e).cast(types[n]).alias(n) if n in types else F.expr(e).alias(n) for n, e in columns.items()]
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return nation.select(
        F.col("n_nationkey").cast("int").alias("id"),
        F.col("n_name").alias("fullName"),
        F.expr(TEAM_COLUMNS["triCode"]).alias("triCode"),
    )


def players(
    spark: SparkSession,
    sf_dir: str,
    where: str | None = None,
    overrides: dict[str, str] | None = None,
    everyone: bool = False,
) -> DataFrame:
    """The roster dimension (``players_info``); ``where`` narrows by attribute.

    ``everyone`` keeps the off-roster parts too (queries that need no
    dimension misses read the whole table).
    """
    part = table(spark, sf_dir, "part").select(*PART_COLUMNS)
    if not everyone:
        part = part.filter(F.expr(PLAYER_FILTER))
    if where:
        part = part.filter(F.expr(where))
    return _typed(part, {**PLAYER_COLUMNS, **(overrides or {})}, PLAYERS_INFO_TABLE)


def games(
    spark: SparkSession,
    sf_dir: str,
    where: str | None = None,
    overrides: dict[str, str] | None = None,
) -> DataFrame:
    """Per-player game log rows (``games_info``); ``where`` is a lineitem predicate."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
    if where:
        li = li.filter(F.expr(where))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = li.join(sup, li["l_suppkey"] == sup["s_suppkey"], "inner")
    return _typed(joined, {**GAME_COLUMNS, **(overrides or {})}, GAMES_INFO_TABLE)


OLD_PLAYERS_WHERE = f"p_size <= {OLD_ROSTER_MAX_SIZE}"
NEW_PLAYERS_WHERE = f"p_size >= {NEW_ROSTER_MIN_SIZE}"
NEW_PLAYERS_OVERRIDES = {
    "triCodeCurrent": team_code("(p_size + 1) % 30"),
    "updatedDt": f"'{NEXT_RUN_DATE}'",
}
OLD_GAMES_WHERE = f"l_shipdate < '{OLD_GAMES_BEFORE}'"
NEW_GAMES_WHERE = f"l_shipdate >= '{NEW_GAMES_FROM}'"
NEW_GAMES_OVERRIDES = {"goals": "l_linenumber"}


#: Day-2 game logs that resend history: only goals of returned lines are corrected.
RESENT_GAMES_OVERRIDES = {"goals": "CASE WHEN l_returnflag = 'A' THEN l_linenumber ELSE l_linenumber - 1 END"}


def old_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-1 roster."""
    return players(spark, sf_dir, OLD_PLAYERS_WHERE)


def new_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-2 roster: overlapping membership, a later run date, moved players."""
    return players(spark, sf_dir, NEW_PLAYERS_WHERE, NEW_PLAYERS_OVERRIDES)


def old_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-1 game logs."""
    return games(spark, sf_dir, OLD_GAMES_WHERE)


def new_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-2 game logs: overlapping dates and corrected goal counts."""
    return games(spark, sf_dir, NEW_GAMES_WHERE, NEW_GAMES_OVERRIDES)


def resent_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-2 game logs of which many equal the stored ones."""
    return games(spark, sf_dir, NEW_GAMES_WHERE, RESENT_GAMES_OVERRIDES)
