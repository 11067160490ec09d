"""Landed-payload documents built from the driver tables.

The driver has no JSON payloads, so these views serialise table rows into the
payload shapes the ingest operators read (teams, rosters, game logs,
scoreboards), then the queries parse them back.  Every document holds a
bounded number of records: rows are grouped by ``key div 64`` over a unique
key; a game log groups by player and block of 64 orders, where an order has a
few lines of one player at most.
The element expressions are SQL shared with the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ALL_MEASURES
from . import league_views as V

CHUNK = V.BOARD_SIZE  # records per document

# -- teams payload {"data": [...]} from customer ----------------------------
TEAM_RECORD_COLUMNS = {"id": "c_custkey", "fullName": "c_name", "triCode": "c_mktsegment"}

# -- roster payload {"<group>": [player, ...]} from events -------------------
# Localised fields take every shape the ingest must accept: an object with a
# default, one with an extra language, one without a default, a plain string,
# JSON null and an object lacking the key.
ROSTER_TEAM = "('R' || CAST(CAST(floor(event_id / 64) AS BIGINT) AS STRING))"
ROSTER_GROUP = "event_type"
ROSTER_FIRST_NAME_JSON = (
    "CASE event_type "
    "WHEN 'view' THEN '{\"default\":\"F' || CAST(user_id AS STRING) || '\",\"fr\":\"Fr' || CAST(user_id AS STRING) || '\"}' "
    "WHEN 'error' THEN '\"F' || CAST(user_id AS STRING) || '\"' "
    "WHEN 'signup' THEN '{\"cs\":\"F' || CAST(user_id AS STRING) || '\"}' "
    "ELSE '{\"default\":\"F' || CAST(user_id AS STRING) || '\"}' END"
)
ROSTER_LAST_NAME_JSON = (
    "CASE WHEN event_type = 'purchase' THEN props "
    "ELSE '{\"default\":\"L' || CAST(event_id AS STRING) || '\"}' END"
)
ROSTER_CITY_JSON = "'{\"default\":\"City ' || CAST(user_id AS STRING) || '\"}'"
ROSTER_PROVINCE_JSON = "CASE WHEN event_type = 'error' THEN 'null' ELSE '{\"default\":\"Prov\"}' END"
ROSTER_POSITION = "CASE event_type WHEN 'purchase' THEN 'G' ELSE upper(substr(event_type, 1, 1)) END"
ROSTER_SHOOTS = "CASE WHEN event_id % 2 = 0 THEN 'L' ELSE 'R' END"
ROSTER_BIRTH_DATE = "CAST(CAST(ts AS DATE) AS STRING)"
ROSTER_COUNTRY = "('CTRY' || CAST(user_id % 7 AS STRING))"
ROSTER_ELEMENT_JSON = (
    "'{\"id\":' || CAST(event_id AS STRING)"
    " || ',\"headshot\":\"h/' || CAST(event_id AS STRING) || '.png\"'"
    f" || ',\"firstName\":' || {ROSTER_FIRST_NAME_JSON}"
    f" || ',\"lastName\":' || {ROSTER_LAST_NAME_JSON}"
    f" || ',\"positionCode\":\"' || {ROSTER_POSITION} || '\"'"
    f" || ',\"shootsCatches\":\"' || {ROSTER_SHOOTS} || '\"'"
    f" || ',\"birthDate\":\"' || {ROSTER_BIRTH_DATE} || '\"'"
    f" || ',\"birthCity\":' || {ROSTER_CITY_JSON}"
    f" || ',\"birthCountry\":\"' || {ROSTER_COUNTRY} || '\"'"
    f" || ',\"birthStateProvince\":' || {ROSTER_PROVINCE_JSON} || '}}'"
)

# -- scoreboard payload from orders ----------------------------------------
BOARD = "CAST(floor(o_orderkey / 64) AS BIGINT)"
BOARD_DATE = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
AWAY_NAME = "('Club ' || CAST(o_custkey AS STRING))"
HOME_NAME = "o_orderpriority"
AWAY_SCORE = "CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) % 10 END AS INT)"
HOME_SCORE = (
    "CAST(CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN NULL "
    "ELSE CAST(floor(o_totalprice / 10) AS BIGINT) % 10 END AS INT)"
)
# Game logs containing this time-on-ice value are truncated in transit.
TRUNCATED_MARKER_TOI = "0:50:00"
# Game logs containing this one arrive as an error body without the field.
ERROR_MARKER_TOI = "99999999:00"
ERROR_BODY = '{"error":"not found"}'


def teams_docs(spark: SparkSession, sf: str) -> DataFrame:
    c = V.table(spark, sf, "customer").select(*TEAM_RECORD_COLUMNS.values())
    rec = F.struct(*[F.col(e).alias(n) for n, e in TEAM_RECORD_COLUMNS.items()])
    docs = c.groupBy(F.expr("c_custkey div 64").alias("doc")).agg(F.collect_list(rec).alias("data"))
    return docs.select("doc", F.to_json(F.struct("data")).alias("json"))


# Team records as a source that grows sends them: declared fields only, one more
# field, and two more of which one changes its type.
SHAPED_TEAM_JSON = (
    "'{\"id\":' || CAST(c_custkey AS STRING) || ',\"fullName\":\"' || c_name || '\",\"triCode\":\"' || c_mktsegment || '\"'"
    " || CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN '' WHEN 1 THEN ',\"venue\":' || CAST(c_nationkey AS STRING)"
    " ELSE ',\"venue\":\"N' || CAST(c_nationkey AS STRING) || '\",\"division\":{\"name\":\"' || c_mktsegment || '\"}' END || '}'"
)


def shaped_team_docs(spark: SparkSession, sf: str) -> DataFrame:
    c = V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    docs = c.groupBy(F.expr("c_custkey div 64").alias("doc")).agg(F.concat_ws(",", F.collect_list(F.expr(SHAPED_TEAM_JSON))).alias("body"))
    return docs.select("doc", F.concat(F.lit('{"data":['), F.col("body"), F.lit("]}")).alias("json"))


def roster_docs(spark: SparkSession, sf: str) -> DataFrame:
    ev = V.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "props")
    # One shuffle on the document key serves both grouping levels.
    elems = ev.select(
        F.expr(ROSTER_TEAM).alias("team"),
        F.col(ROSTER_GROUP).alias("grp"),
        F.expr(ROSTER_ELEMENT_JSON).alias("elem"),
    ).repartition("team")
    groups = elems.groupBy("team", "grp").agg(
        F.concat(F.lit('"'), F.col("grp"), F.lit('":['), F.concat_ws(",", F.collect_list("elem")), F.lit("]")).alias("entry")
    )
    docs = groups.groupBy("team").agg(F.concat_ws(",", F.collect_list("entry")).alias("body"))
    return docs.select("team", F.concat(F.lit("{"), F.col("body"), F.lit("}")).alias("json"))


def game_log_docs(
    spark: SparkSession, sf: str, id_as_text: bool = False, with_broken: bool = False
) -> DataFrame:
    """One document per (player, block of 64 order keys): ``{"gameLog": [...]}``.

    With ``with_broken``, documents holding a game with
    ``TRUNCATED_MARKER_TOI`` are cut in half, as a failed transfer leaves them,
    and those holding ``ERROR_MARKER_TOI`` are replaced by an error body.
    """
    g = V.games(spark, sf)
    game_id = F.col("gameId").cast("string") if id_as_text else F.col("gameId")
    rec = F.struct(
        game_id.alias("gameId"), "teamAbbrev", "opponentAbbrev", "homeRoadFlag",
        F.struct(F.col("teamAbbrev").alias("default")).alias("commonName"),
        F.struct(F.col("opponentAbbrev").alias("default")).alias("opponentCommonName"),
        "toi", *ALL_MEASURES,
    )
    docs = g.groupBy("playerId", F.expr("gameId div 64").alias("chunk")).agg(
        F.collect_list(rec).alias("gameLog"),
        F.max((F.col("toi") == F.lit(TRUNCATED_MARKER_TOI)).cast("int")).alias("_broken"),
        F.max((F.col("toi") == F.lit(ERROR_MARKER_TOI)).cast("int")).alias("_error"),
    )
    text = F.to_json(F.struct("gameLog"))
    broken = F.substring(text, 1, (F.length(text) / 2).cast("int"))
    return docs.select(
        "playerId", "chunk",
        F.when(F.lit(with_broken) & (F.col("_error") == 1), F.lit(ERROR_BODY))
        .when(F.lit(with_broken) & (F.col("_broken") == 1), broken).otherwise(text).alias("json"),
    )


def scoreboard_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One scoreboard per block of 64 order keys: dates sorted, games of a date
    in order-key order; an unscored side has no ``score`` key."""
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    side = lambda name, score: F.struct(
        F.struct(F.expr(name).alias("default")).alias("name"), F.expr(score).alias("score")
    )
    game = F.struct(side(AWAY_NAME, AWAY_SCORE).alias("awayTeam"), side(HOME_NAME, HOME_SCORE).alias("homeTeam"))
    # One shuffle on the board key serves both grouping levels.
    rows = o.select(
        F.expr(BOARD).alias("board"), F.expr(BOARD_DATE).alias("date"),
        F.struct(F.col("o_orderkey").alias("k"), game.alias("g")).alias("kg"),
    ).repartition("board")
    days = rows.groupBy("board", "date").agg(F.array_sort(F.collect_list("kg")).alias("kgs"))
    days = days.select(
        "board", F.struct("date", F.transform("kgs", lambda x: x["g"]).alias("games")).alias("day")
    )
    boards = days.groupBy("board").agg(F.array_sort(F.collect_list("day")).alias("gamesByDate"))
    return boards.select("board", F.to_json(F.struct("gamesByDate")).alias("json"))
