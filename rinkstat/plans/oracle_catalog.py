"""``name -> DuckDB SQL`` for the registered queries (see :mod:`.catalog`)."""

from __future__ import annotations

from ..schemas import AGG_KEYS
from . import league_views as V
from .oracle import (
    BASE, MART_CTE, aggregate_sql, card_rows_sql, card_sql, games_cte, players_cte,
    rollup_sql, teams_cte, toi_seconds_sql, with_views,
)

_W = with_views(*BASE)
_GAMES = with_views(games_cte())
_EVERYONE = with_views(players_cte(everyone=True))
_OLD_NEW_PLAYERS = with_views(
    players_cte("old", V.OLD_PLAYERS_WHERE),
    players_cte("new", V.NEW_PLAYERS_WHERE, V.NEW_PLAYERS_OVERRIDES),
)
_OLD_NEW_EVERYONE = with_views(
    players_cte("old", V.OLD_PLAYERS_WHERE, everyone=True),
    players_cte("new", V.NEW_PLAYERS_WHERE, V.NEW_PLAYERS_OVERRIDES, everyone=True),
)
_OLD_NEW_GAMES = with_views(
    games_cte("old", V.OLD_GAMES_WHERE),
    games_cte("new", V.NEW_GAMES_WHERE, V.NEW_GAMES_OVERRIDES),
)
_MART_COLS = "* EXCLUDE (updatedDt)"
_AGG_KEYS = ", ".join(AGG_KEYS)


def _games_order() -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in V.GAME_COLUMNS)


ORACLE_SQL: dict[str, str] = {
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem",
    "scan_parquet_filtered": (
        "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10"
    ),
    "project_columns": _GAMES + "SELECT playerId, gameId, teamAbbrev, homeRoadFlag, toi FROM games",
    "drop_columns": _W + f"SELECT {_MART_COLS} FROM mart",
    "rename_columns": _EVERYONE
    + "SELECT * EXCLUDE (playerId, triCodeCurrent), playerId AS id, triCodeCurrent AS currentTeam FROM players",
    "stamp_run_date": _EVERYONE + f"SELECT * REPLACE ('{V.NEXT_RUN_DATE}' AS updatedDt) FROM players",
    "full_name": _EVERYONE + "SELECT playerId, concat_ws(' ', firstName, lastName) AS playersFIO FROM players",
    "filter_not_equal_3vl": _EVERYONE + "SELECT * FROM players WHERE positionCode <> 'G'",
    "filter_equal": _EVERYONE + "SELECT * FROM players WHERE positionCode = 'G'",
    "anti_join_single_key": _OLD_NEW_EVERYONE + "SELECT * FROM old ANTI JOIN new USING (playerId)",
    "anti_join_composite_key": _OLD_NEW_GAMES + "SELECT * FROM old ANTI JOIN new USING (playerId, gameId)",
    "left_join_dimension": with_views(games_cte(), players_cte())
    + "SELECT * FROM games LEFT JOIN players USING (playerId)",
    "role_playing_joins": with_views(games_cte(), players_cte(), teams_cte())
    + (
        "SELECT g.*, p.triCodeCurrent, t1.fullName AS teamFullName, t2.fullName AS opponentFullName, "
        "t3.fullName AS currentTeamFullName FROM games g LEFT JOIN players p USING (playerId) "
        "LEFT JOIN teams t1 ON g.teamAbbrev = t1.triCode LEFT JOIN teams t2 ON g.opponentAbbrev = t2.triCode "
        "LEFT JOIN teams t3 ON p.triCodeCurrent = t3.triCode"
    ),
    "player_game_mart": _W + "SELECT * FROM mart",
    "upsert_single_key": _OLD_NEW_EVERYONE
    + "SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (playerId)",
    "upsert_composite_key": _OLD_NEW_GAMES
    + "SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (playerId, gameId)",
    "upsert_changes": with_views(
        games_cte("old", V.OLD_GAMES_WHERE), games_cte("new", V.NEW_GAMES_WHERE, V.RESENT_GAMES_OVERRIDES),
        "o AS (SELECT playerId, gameId, count(*) AS n, list_sort(list(t)) AS r FROM old t GROUP BY playerId, gameId)",
        "n AS (SELECT playerId, gameId, count(*) AS n, list_sort(list(t)) AS r FROM new t GROUP BY playerId, gameId)",
    ) + (
        "SELECT playerId, gameId, CASE WHEN o.n IS NULL THEN 'inserted' WHEN n.n IS NULL THEN 'kept' "
        "WHEN o.r = n.r THEN 'unchanged' ELSE 'updated' END AS change, "
        "CAST(coalesce(n.n, 0) AS BIGINT) AS n_new, CAST(coalesce(o.n, 0) AS BIGINT) AS n_old "
        "FROM o FULL JOIN n USING (playerId, gameId)"
    ),
    "discover_payload_fields": """
SELECT 'id' AS field, count(*) AS n_records, 'BIGINT' AS types, 'BIGINT' AS merged_type, true AS declared FROM customer
UNION ALL SELECT 'fullName', count(*), 'STRING', 'STRING', true FROM customer
UNION ALL SELECT 'triCode', count(*), 'STRING', 'STRING', true FROM customer
UNION ALL SELECT 'venue', count(*), 'BIGINT,STRING', 'VARIANT', false FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'division', count(*), 'OBJECT', 'OBJECT<name: STRING>', false FROM customer WHERE c_custkey % 3 = 2""",
    "keep_payload_extras": """
SELECT c_custkey AS id, c_name AS fullName, c_mktsegment AS triCode,
       CASE c_custkey % 3 WHEN 1 THEN '{"venue":' || c_nationkey || '}'
         WHEN 2 THEN '{"division":{"name":"' || c_mktsegment || '"},"venue":"N' || c_nationkey || '"}' END AS extras
FROM customer""",
    "write_file_count": with_views(teams_cte()) + "SELECT *, 2 AS n_files FROM teams",
    "upsert_first_load": _GAMES + "SELECT * FROM games",
    "skater_aggregate": _W + aggregate_sql("skater"),
    "goalie_aggregate": _W + aggregate_sql("goalie"),
    "skater_aggregate_over_mart": _W + aggregate_sql("skater"),
    "rollup_home_road": _W + rollup_sql("skater"),
    "count_non_null": _GAMES
    + "SELECT teamAbbrev, COUNT(plusMinus) AS plusMinus_count FROM games GROUP BY teamAbbrev",
    "first_row_per_name": _W + card_rows_sql("skater"),
    "sort_by_key": _W + aggregate_sql("skater") + f"\nORDER BY {_AGG_KEYS}",
    "preview_limit": _GAMES + f"SELECT * FROM games ORDER BY {_games_order()} LIMIT 20",
    "toi_seconds": _GAMES + f"SELECT playerId, gameId, toi, {toi_seconds_sql('toi')} AS toi_sec FROM games",
    "named_sql_function": _GAMES
    + f"SELECT playerId, gameId, toi, {toi_seconds_sql('toi')} AS toi_sec FROM games",
    "goalie_percentage": _W
    + (
        f"SELECT {_AGG_KEYS}, shotsAgainst, goalsAgainst, "
        "round_even(shotsAgainst / NULLIF(shotsAgainst + goalsAgainst, 0) * 100, 2) AS perc_goals, "
        "round_even((shotsAgainst - goalsAgainst) / NULLIF(shotsAgainst, 0) * 100, 2) AS save_pct "
        f"FROM ({aggregate_sql('goalie')}) a"
    ),
    "age_years": _EVERYONE
    + (
        "SELECT playerId, birthDate, "
        f"CAST(datesub('year', birthDate, DATE '{V.AS_OF}') AS INTEGER) AS age FROM players"
    ),
    "avg_toi": _W
    + (
        f"SELECT {_AGG_KEYS}, gamesCNT, toi, "
        "CAST(trunc(toi / NULLIF(gamesCNT, 0)) AS BIGINT) // 60 AS avg_toi_min, "
        "CAST(trunc(toi / NULLIF(gamesCNT, 0)) AS BIGINT) % 60 AS avg_toi_sec "
        f"FROM ({aggregate_sql('skater')}) a"
    ),
    "name_link_parts": _EVERYONE
    + (
        "SELECT playerId, playersFIO, "
        "concat_ws('%20', string_split(playersFIO, ' ')[1], string_split(playersFIO, ' ')[2]) AS name_link "
        "FROM (SELECT playerId, concat_ws(' ', firstName, lastName) AS playersFIO FROM players) p"
    ),
    "player_card_skater": _W + card_sql("skater"),
    "player_card_goalie": _W + card_sql("goalie"),
    "player_card_lookup_skater": _W + f"SELECT * FROM ({card_sql('skater')}) k WHERE playersFIO IN ('cold anvil', 'no one')",
    "player_card_lookup_goalie": _W + f"SELECT * FROM ({card_sql('goalie')}) k WHERE playersFIO IN ('cold anvil', 'no one')",
}


# -- payload ingest and scoreboard ---------------------------------------------

from . import payload_views as PV  # noqa: E402

_ROSTER_PLAYERS = f"""
SELECT event_id AS playerId,
       'h/' || CAST(event_id AS STRING) || '.png' AS headshot,
       CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN '' ELSE 'F' || CAST(user_id AS STRING) END AS firstName,
       CASE WHEN event_type = 'purchase' THEN '' ELSE 'L' || CAST(event_id AS STRING) END AS lastName,
       {PV.ROSTER_POSITION} AS positionCode,
       {PV.ROSTER_SHOOTS} AS shootsCatches,
       CAST(ts AS DATE) AS birthDate,
       'City ' || CAST(user_id AS STRING) AS birthCity,
       {PV.ROSTER_COUNTRY} AS birthCountry,
       CASE WHEN event_type = 'error' THEN '' ELSE 'Prov' END AS birthStateProvince,
       {PV.ROSTER_TEAM} AS triCodeCurrent,
       '{V.RUN_DATE}' AS updatedDt
FROM events"""

_GAMES_INFO_COLS = ", ".join(V.GAME_COLUMNS)
_BROKEN_DOCS = (
    "broken AS (SELECT DISTINCT playerId, CAST(floor(gameId / 64) AS BIGINT) AS chunk FROM games "
    f"WHERE toi IN ('{PV.TRUNCATED_MARKER_TOI}', '{PV.ERROR_MARKER_TOI}'))"
)
_GOOD_GAMES = (
    f"SELECT {_GAMES_INFO_COLS} FROM games g WHERE NOT EXISTS (SELECT 1 FROM broken b "
    "WHERE b.playerId = g.playerId AND b.chunk = CAST(floor(g.gameId / 64) AS BIGINT))"
)

_BOARD = f"""sb AS (
  SELECT {PV.BOARD} AS board, {PV.BOARD_DATE} AS date_play, o_orderkey,
         {PV.AWAY_NAME} AS away_teams, {PV.HOME_NAME} AS home_teams,
         {PV.AWAY_SCORE} AS away_result, {PV.HOME_SCORE} AS home_result
  FROM orders),
pos AS (
  SELECT *,
         CAST(dense_rank() OVER (PARTITION BY board ORDER BY date_play) - 1 AS INTEGER) AS date_pos,
         CAST(row_number() OVER (PARTITION BY board, date_play ORDER BY o_orderkey) - 1 AS INTEGER) AS game_pos,
         min(CASE WHEN away_result IS NULL THEN o_orderkey END) OVER (PARTITION BY board, date_play) AS cut
  FROM sb),
kept AS (SELECT * FROM pos WHERE cut IS NULL OR o_orderkey < cut),
marked AS (
  SELECT *, (game_pos = 0 AND date_pos > min(date_pos) OVER (PARTITION BY board)) AS new_date FROM kept)
"""
_BOARD_COLS = "board, date_pos, game_pos, away_teams, home_teams, away_result, home_result, date_play"
_LINE = (
    "date_play || ' ' || away_teams || ' ' || coalesce(CAST(away_result AS STRING), '-') || ':' || "
    "coalesce(CAST(home_result AS STRING), '-') || ' ' || home_teams || '.' || chr(10)"
)

ORACLE_SQL.update({
    "flatten_record_array": "SELECT c_custkey AS id, c_name AS fullName, c_mktsegment AS triCode FROM customer",
    "flatten_map_of_arrays": _ROSTER_PLAYERS,
    "localized_default": (
        "SELECT playerId, firstName, lastName, birthCity, birthStateProvince FROM (" + _ROSTER_PLAYERS + ") r"
    ),
    "flatten_keyed_array": _GAMES + f"SELECT {_GAMES_INFO_COLS} FROM games",
    "cast_id": _GAMES + "SELECT playerId, gameId FROM games",
    "semi_join_known_keys": with_views(games_cte(), players_cte())
    + f"SELECT {_GAMES_INFO_COLS} FROM games SEMI JOIN players USING (playerId)",
    "skip_malformed_payloads": with_views(games_cte(), _BROKEN_DOCS) + _GOOD_GAMES,
    "rejected_payloads": with_views(games_cte(), _BROKEN_DOCS) + "SELECT COUNT(*) AS rejected_docs FROM broken",
    "union_merge_schema": with_views(games_cte(), players_cte())
    + (
        "SELECT g.* EXCLUDE (gamesStarted, shotsAgainst, goalsAgainst, shutouts) FROM games g "
        "LEFT JOIN players p USING (playerId) WHERE p.positionCode IS DISTINCT FROM 'G' "
        "UNION ALL BY NAME "
        "SELECT g.* EXCLUDE (plusMinus, powerPlayGoals, powerPlayPoints, gameWinningGoals, otGoals, shots, "
        "shifts, shorthandedGoals) FROM games g "
        "LEFT JOIN players p USING (playerId) WHERE p.positionCode IS NOT DISTINCT FROM 'G'"
    ),
    "flatten_nested_scoreboard": with_views(_BOARD) + f"SELECT {_BOARD_COLS} FROM pos",
    "take_while_scored": with_views(_BOARD) + f"SELECT {_BOARD_COLS} FROM kept",
    "result_lines": with_views(_BOARD) + f"SELECT board, date_pos, game_pos, {_LINE} AS line FROM kept",
    "date_change_marks": with_views(_BOARD) + "SELECT board, date_pos, game_pos, date_play, new_date FROM marked",
    "results_digest": with_views(_BOARD)
    + f"SELECT board, date_pos, game_pos, CASE WHEN new_date THEN chr(10) ELSE '' END || {_LINE} AS line FROM marked",
})

ORACLE_SQL.update({
    "write_dated_partition": _OLD_NEW_GAMES
    + (
        f"SELECT *, DATE '{V.RUN_DATE}' AS ds FROM old "
        f"UNION ALL SELECT *, DATE '{V.NEXT_RUN_DATE}' AS ds FROM new"
    ),
    "write_snapshot": ORACLE_SQL["upsert_composite_key"],
})


def _card_text_sql(kind: str) -> str:
    nl = " || chr(10) || "
    parts = [
        "'Born: ' || CAST(birthDate AS VARCHAR)",
        "'Age: ' || CAST(age AS VARCHAR)",
        "'Country: ' || birthCountry",
        "'City: ' || birthCity",
        "'Team: ' || teamFullName || ' (' || teamAbbrev || ')'",
        "'Games: ' || CAST(gamesCNT AS VARCHAR)",
    ]
    if kind == "goalie":
        parts += [
            "'Games started: ' || CAST(gamesStarted AS VARCHAR)",
            "'Shutouts: ' || CAST(shutouts AS VARCHAR)",
            "'Saved shots, %: ' || CAST(perc_goals AS VARCHAR)",
        ]
    parts.append("'Average time on ice: ' || CAST(avg_toi_min AS VARCHAR) || ' min, ' || CAST(avg_toi_sec AS VARCHAR) || ' s'")
    if kind == "skater":
        parts.append("'Points: ' || CAST(points AS VARCHAR)")
    parts.append("'Goals: ' || CAST(goals AS VARCHAR)")
    if kind == "skater":
        parts.append("'Plus/minus: ' || CAST(plusMinus AS VARCHAR)")
    parts.append("'Penalty minutes: ' || CAST(pim AS VARCHAR)")
    # concat_ws skips NULL parts, as Spark's does
    body = "concat_ws(chr(10), " + ", ".join(parts) + ")"
    return _W + f"SELECT playersFIO, {body} AS card FROM ({card_sql(kind)}) c"


ORACLE_SQL.update({
    "results_digest_text": with_views(_BOARD)
    + (
        "SELECT board, string_agg(CASE WHEN new_date THEN chr(10) ELSE '' END || "
        f"{_LINE}, '' ORDER BY date_pos, game_pos) AS digest FROM marked GROUP BY board"
    ),
    "player_card_text_skater": _card_text_sql("skater"),
    "player_card_text_goalie": _card_text_sql("goalie"),
})


_BLOCK = "CAST(floor(gameId / 4096) % 16 AS INTEGER)"
_UPSERTED_GAMES = (
    "games AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (playerId, gameId))"
)

ORACLE_SQL.update({
    "upsert_partitioned": _OLD_NEW_GAMES
    + (
        f"SELECT *, {_BLOCK} AS block FROM new UNION ALL "
        f"SELECT *, {_BLOCK} AS block FROM old ANTI JOIN new USING (playerId, gameId)"
    ),
    "incremental_skater_aggregate": with_views(
        teams_cte(), players_cte(),
        games_cte("old", V.OLD_GAMES_WHERE),
        games_cte("new", V.NEW_GAMES_WHERE, V.NEW_GAMES_OVERRIDES),
        _UPSERTED_GAMES, MART_CTE,
    ) + aggregate_sql("skater"),
})
for _kind in ("skater", "goalie"):
    ORACLE_SQL[f"{_kind}_aggregate_by_deltas"] = with_views(
        teams_cte(), players_cte(),
        games_cte("old", V.OLD_GAMES_WHERE), games_cte("new", V.NEW_GAMES_WHERE, V.NEW_GAMES_OVERRIDES),
        _UPSERTED_GAMES, MART_CTE,
    ) + aggregate_sql(_kind)

ORACLE_SQL["incremental_mart"] = with_views(
    teams_cte(),
    players_cte("old_p", V.OLD_PLAYERS_WHERE),
    players_cte("new_p", V.NEW_PLAYERS_WHERE, V.NEW_PLAYERS_OVERRIDES),
    "players AS (SELECT * FROM new_p UNION ALL SELECT * FROM old_p ANTI JOIN new_p USING (playerId))",
    games_cte("old", V.OLD_GAMES_WHERE),
    games_cte("new", V.NEW_GAMES_WHERE, V.NEW_GAMES_OVERRIDES),
    _UPSERTED_GAMES, MART_CTE,
) + f"SELECT *, {_BLOCK} AS block FROM mart"

_FLAT_GAMES = with_views(
    f"flat AS (SELECT o_orderkey AS gameId, {PV.BOARD_DATE} AS date_play, {PV.AWAY_NAME} AS away_teams, "
    f"{PV.AWAY_SCORE} AS away_result, {PV.HOME_SCORE} AS home_result FROM orders)"
)
ORACLE_SQL.update({
    "anti_join_bucketed_history": ORACLE_SQL["anti_join_composite_key"],
    "upsert_bucketed_history": ORACLE_SQL["upsert_composite_key"],
    "take_while_ordered": _FLAT_GAMES
    + "SELECT * FROM flat QUALIFY count(*) FILTER (away_result IS NULL) OVER (PARTITION BY date_play ORDER BY gameId) = 0",
    "date_change_marks_ordered": _FLAT_GAMES
    + "SELECT *, coalesce(date_play <> lag(date_play) OVER (ORDER BY gameId), false) AS new_date FROM flat",
})
ORACLE_SQL.update({
    "lookup_name_unsorted": _W + f"SELECT * FROM mart WHERE playersFIO = '{V.SOUGHT_NAME}'",
    "lookup_clustered_keys": _GAMES
    + f"SELECT *, 'player' AS sought FROM games WHERE playerId = {V.SOUGHT_PLAYER} "
    + f"UNION ALL SELECT *, 'game' AS sought FROM games WHERE gameId = {V.SOUGHT_GAME}",
})
