"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reshapes the driver tables into league tables
(:mod:`rinkstat.plans.league_views`) and runs one operator or composition over
the whole input.  The matching DuckDB text is in :mod:`rinkstat.plans.oracle_catalog`.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as X
from ..functions.sql import register_toi_seconds
from ..operators import aggregates as A
from ..operators import changes as CH
from ..operators import columns as P
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import merge as M
from ..operators import ordered as O
from ..operators import segments as SG
from ..schemas import (
    AGG_KEYS, ALL_MEASURES, GAME_LOG_PAYLOAD, GOALIE_MEASURES, ROSTER_PAYLOAD, SCOREBOARD_PAYLOAD,
    SKATER_MEASURES, TEAM_RECORD, TEAMS_PAYLOAD, game_log_payload,
)
from ..session import scratch_dir
from ..sinks import bucketed as B
from ..sinks import layout as LY
from ..sinks import parquet as K
from ..sources import discovery as SD
from ..sources import payloads as S
from ..sources.tables import scan_parquet
from . import cards as C
from . import digest as D
from . import league_views as V
from . import payload_views as PV
from . import player_stats as PS
from .mart import TEAM_ROLES, player_game_mart

Query = Callable[[SparkSession, str], DataFrame]


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return player_game_mart(V.games(spark, sf), V.players(spark, sf), V.teams(spark, sf))


# -- sources / projections -------------------------------------------------

def q_scan_parquet(spark, sf):
    return scan_parquet(
        spark, os.path.join(sf, "lineitem.parquet"), ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"],
    )


def q_scan_parquet_filtered(spark, sf):
    return scan_parquet(
        spark, os.path.join(sf, "lineitem.parquet"),
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"],
        F.col("l_quantity") >= 10,
    )


def q_project_columns(spark, sf):
    return P.project(V.games(spark, sf), ["playerId", "gameId", "teamAbbrev", "homeRoadFlag", "toi"])


def q_drop_columns(spark, sf):
    return P.drop_columns(_mart(spark, sf), ["updatedDt", "commonName", "opponentCommonName"])


def q_rename_columns(spark, sf):
    return P.rename_columns(V.players(spark, sf, everyone=True), {"playerId": "id", "triCodeCurrent": "currentTeam"})


def q_stamp_run_date(spark, sf):
    return P.stamp_run_date(V.players(spark, sf, everyone=True).drop("updatedDt"), V.NEXT_RUN_DATE)


def q_full_name(spark, sf):
    p = V.players(spark, sf, everyone=True)
    return p.select("playerId", X.full_name("firstName", "lastName").alias("playersFIO"))


# -- filters -----------------------------------------------------------------

def q_filter_not_equal_3vl(spark, sf):
    return FL.skaters(V.players(spark, sf, everyone=True))


def q_filter_equal(spark, sf):
    return FL.goalies(V.players(spark, sf, everyone=True))


# -- joins -----------------------------------------------------------------

def _rosters(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Day-1 and day-2 rosters of all parts (merges need no dimension misses)."""
    old = V.players(spark, sf, V.OLD_PLAYERS_WHERE, everyone=True)
    return old, V.players(spark, sf, V.NEW_PLAYERS_WHERE, V.NEW_PLAYERS_OVERRIDES, everyone=True)


def q_anti_join_single_key(spark, sf):
    return J.anti_join(*_rosters(spark, sf), "playerId")


def q_anti_join_composite_key(spark, sf):
    return J.anti_join(V.old_games(spark, sf), V.new_games(spark, sf), ["playerId", "gameId"])


def q_left_join_dimension(spark, sf):
    return J.left_join_dimension(V.games(spark, sf), V.players(spark, sf), "playerId")


def q_role_playing_joins(spark, sf):
    """Team played for, opponent and current team: three roles of one dimension."""
    current = V.players(spark, sf).select("playerId", "triCodeCurrent")
    games = J.left_join_dimension(V.games(spark, sf), current, "playerId")
    return J.role_playing_join(games, V.teams(spark, sf), "triCode", "fullName", TEAM_ROLES)


def q_player_game_mart(spark, sf):
    return _mart(spark, sf)


# -- merge -----------------------------------------------------------------

def q_upsert_single_key(spark, sf):
    old, new = _rosters(spark, sf)
    return M.upsert(new, old, "playerId")


def q_upsert_composite_key(spark, sf):
    return M.upsert(V.new_games(spark, sf), V.old_games(spark, sf), ["playerId", "gameId"])


GAME_KEYS = ["playerId", "gameId"]


def q_upsert_changes(spark, sf):
    """What a day's upsert changes: one row per key, several lines of a key compared as a bag."""
    return CH.change_feed(V.resent_games(spark, sf), V.old_games(spark, sf), GAME_KEYS)


def _by_deltas(spark, sf, kind: str) -> DataFrame:
    """Aggregate from day-1's stored state and the changed games of day 2 only."""
    measures = [*ALL_MEASURES, "toi"]
    seconds = lambda games: games.withColumn("toi", X.toi_seconds("toi"))
    path = scratch_dir(spark, "game-state")
    K.write_snapshot(CH.aggregate_state(seconds(V.old_games(spark, sf)), PS.PLAYER_GRAIN, measures, "gameId"), path)
    retracted, added = CH.split_changes(V.new_games(spark, sf), V.old_games(spark, sf), GAME_KEYS)
    state = CH.apply_deltas(spark.read.parquet(path), seconds(retracted), seconds(added), PS.PLAYER_GRAIN, measures, "gameId")
    partials = CH.aggregate_of(state, PS.PLAYER_GRAIN, measures, "gameId", "gamesCNT")
    return PS.player_aggregate(partials, V.players(spark, sf), V.teams(spark, sf), kind, pre_aggregated=True)


def q_skater_aggregate_by_deltas(spark, sf):
    return _by_deltas(spark, sf, "skater")


def q_goalie_aggregate_by_deltas(spark, sf):
    return _by_deltas(spark, sf, "goalie")


# Buckets of the games history: at least so many, and more where one would hold over so many rows.  Kept for the table's life.
GAME_BUCKETS = 16
BUCKET_ROWS = 500_000


def _bucketed_games(spark, sf) -> str:
    name = f"games_{uuid.uuid4().hex}"
    games = V.old_games(spark, sf)
    buckets = B.buckets_for(games, GAME_BUCKETS, BUCKET_ROWS)
    B.write_bucketed(games, name, scratch_dir(spark, "games-buckets"), GAME_KEYS, buckets)
    return name


def q_anti_join_bucketed_history(spark, sf):
    return B.anti_join_bucketed(_bucketed_games(spark, sf), V.new_games(spark, sf), GAME_KEYS)


def q_upsert_bucketed_history(spark, sf):
    """Day-1 games in buckets, the day-2 merge and its rerun: the history is shuffled in none of them."""
    history = _bucketed_games(spark, sf)
    for _ in range(2):
        merged = f"games_{uuid.uuid4().hex}"
        result = B.merge_bucketed(V.new_games(spark, sf), history, merged, scratch_dir(spark, "games-buckets"), GAME_KEYS)
        history = merged
    return result


def q_upsert_first_load(spark, sf):
    return M.upsert(V.games(spark, sf), None, ["playerId", "gameId"])


# -- aggregates --------------------------------------------------------------

def _base(spark, sf):
    return V.games(spark, sf), V.players(spark, sf), V.teams(spark, sf)


def q_skater_aggregate(spark, sf):
    return PS.skater_aggregate_from_tables(*_base(spark, sf))


def q_goalie_aggregate(spark, sf):
    return PS.goalie_aggregate_from_tables(*_base(spark, sf))


def q_skater_aggregate_over_mart(spark, sf):
    """The same aggregate over the stored mart: no join lies between the scan and the aggregate."""
    path = scratch_dir(spark, "mart")
    K.write_snapshot(_mart(spark, sf), path)
    return A.skater_aggregate(spark.read.parquet(path))


def q_rollup_home_road(spark, sf):
    return A.rollup_home_road(q_skater_aggregate(spark, sf))


def q_count_non_null(spark, sf):
    return A.count_non_null(V.games(spark, sf), "plusMinus", ["teamAbbrev"], "plusMinus_count")


def q_first_row_per_name(spark, sf):
    return C.card_rows(A.rollup_home_road(q_skater_aggregate(spark, sf)))


def q_sort_by_key(spark, sf):
    return O.sort_by(q_skater_aggregate(spark, sf), ["playerId", *AGG_KEYS[1:]])


def q_preview_limit(spark, sf):
    g = V.games(spark, sf)
    return O.preview(g, g.columns, 20)


# -- scalar functions --------------------------------------------------------

def q_toi_seconds(spark, sf):
    g = V.games(spark, sf)
    return g.select("playerId", "gameId", "toi", X.toi_seconds("toi").alias("toi_sec"))


def q_named_sql_function(spark, sf):
    fn = register_toi_seconds(spark)
    view = f"games_{uuid.uuid4().hex[:8]}"
    V.games(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT playerId, gameId, toi, {fn}(toi) AS toi_sec FROM {view}")


def q_goalie_percentage(spark, sf):
    agg = q_goalie_aggregate(spark, sf)
    return agg.select(
        *AGG_KEYS, "shotsAgainst", "goalsAgainst",
        X.goalie_percentage("shotsAgainst", "goalsAgainst").alias("perc_goals"),
        X.save_percentage("shotsAgainst", "goalsAgainst").alias("save_pct"),
    )


def q_age_years(spark, sf):
    p = V.players(spark, sf, everyone=True)
    return p.select("playerId", "birthDate", X.age_years("birthDate", F.lit(V.AS_OF).cast("date")).alias("age"))


def q_avg_toi(spark, sf):
    agg = q_skater_aggregate(spark, sf)
    avg = X.avg_toi_seconds("toi", "gamesCNT")
    return agg.select(
        *AGG_KEYS, "gamesCNT", "toi",
        X.minutes_part(avg).alias("avg_toi_min"), X.seconds_part(avg).alias("avg_toi_sec"),
    )


def q_name_link_parts(spark, sf):
    p = V.players(spark, sf, everyone=True).select("playerId", X.full_name("firstName", "lastName").alias("playersFIO"))
    return p.select("playerId", "playersFIO", X.name_link("playersFIO").alias("name_link"))


# -- presentation ------------------------------------------------------------

def q_player_card_skater(spark, sf):
    return C.cards_from_rolled(PS.card_aggregate(*_base(spark, sf), "skater"), "skater", V.AS_OF)


def q_player_card_goalie(spark, sf):
    return C.cards_from_rolled(PS.card_aggregate(*_base(spark, sf), "goalie"), "goalie", V.AS_OF)


LOOKUP_NAME = "cold anvil"
UNKNOWN_NAME = "no one"


def _card_lookup(spark, sf, kind: str) -> DataFrame:
    """Cards of one name and of an unknown one (no card), from the stored aggregate."""
    path = scratch_dir(spark, f"{kind}s-agg")
    K.write_snapshot(PS.player_aggregate(*_base(spark, sf), kind), path, sort_by=["playersFIO"])
    stored = spark.read.parquet(path)
    return M.union_by_name(*[C.cards_from_aggregate(stored, kind, V.AS_OF, n) for n in (LOOKUP_NAME, UNKNOWN_NAME)])


def q_lookup_name_unsorted(spark, sf):
    """One player's games from the stored mart, whose rows lie in no order of names."""
    path = scratch_dir(spark, "mart-names")
    LY.write_for_lookup(_mart(spark, sf), path, ["playersFIO"])
    return FL.by_exact_name(spark.read.parquet(path), V.SOUGHT_NAME)


def q_lookup_clustered_keys(spark, sf):
    """Games clustered on both keys: those of one player and those of one game."""
    path = scratch_dir(spark, "games-clustered")
    LY.write_clustered(V.games(spark, sf), path, GAME_KEYS)
    games = spark.read.parquet(path)
    of_player = games.filter(F.col("playerId") == V.SOUGHT_PLAYER).withColumn("sought", F.lit("player"))
    return of_player.union(games.filter(F.col("gameId") == V.SOUGHT_GAME).withColumn("sought", F.lit("game")))


def q_player_card_lookup_skater(spark, sf):
    return _card_lookup(spark, sf, "skater")


def q_player_card_lookup_goalie(spark, sf):
    return _card_lookup(spark, sf, "goalie")


# -- payload ingest ----------------------------------------------------------

def _good(docs: DataFrame, schema, required: tuple[str, ...] = ()) -> DataFrame:
    good, _rejected = S.split_malformed(S.parse_payloads(docs, "json", schema), required)
    return good


def q_flatten_record_array(spark, sf):
    return S.flatten_record_array(_good(PV.teams_docs(spark, sf), TEAMS_PAYLOAD), "data")


def _team_records(spark, sf):
    return SD.records(PV.shaped_team_docs(spark, sf), "json", "data")


def q_discover_payload_fields(spark, sf):
    """Fields met in payloads of three shapes, declared or not."""
    return SD.discovered_fields(_team_records(spark, sf), TEAM_RECORD)


def q_keep_payload_extras(spark, sf):
    """Typed records; what the schema doesn't declare stays in one VARIANT column, shown as JSON."""
    rows = SD.typed_with_extras(_team_records(spark, sf), TEAM_RECORD)
    return rows.withColumn(SD.EXTRAS, F.to_json(SD.EXTRAS))


def _roster_players(spark, sf):
    docs = _good(PV.roster_docs(spark, sf), ROSTER_PAYLOAD)
    records = S.flatten_map_of_arrays(docs, "value", carry=["team"])
    return S.roster_to_players_info(records, "team", V.RUN_DATE)


def q_flatten_map_of_arrays(spark, sf):
    return _roster_players(spark, sf)


def q_localized_default(spark, sf):
    return _roster_players(spark, sf).select(
        "playerId", "firstName", "lastName", "birthCity", "birthStateProvince"
    )


def _game_log_rows(docs: DataFrame, schema=GAME_LOG_PAYLOAD) -> DataFrame:
    good = _good(docs, schema, ("gameLog",))
    return S.game_log_to_games_info(S.flatten_keyed_array(good, "gameLog", {"playerId": "playerId"}))


def q_flatten_keyed_array(spark, sf):
    return _game_log_rows(PV.game_log_docs(spark, sf))


def q_cast_id(spark, sf):
    """Game ids that arrive quoted are cast to BIGINT on ingest."""
    schema = game_log_payload(T.StringType())
    rows = _game_log_rows(PV.game_log_docs(spark, sf, id_as_text=True), schema)
    return rows.select("playerId", "gameId")


def q_semi_join_known_keys(spark, sf):
    docs = J.semi_join(PV.game_log_docs(spark, sf), V.players(spark, sf), "playerId")
    return _game_log_rows(docs)


def q_skip_malformed_payloads(spark, sf):
    return _game_log_rows(PV.game_log_docs(spark, sf, with_broken=True))


def q_rejected_payloads(spark, sf):
    """Documents cut in transit and error bodies without the field, counted together."""
    parsed = S.parse_payloads(PV.game_log_docs(spark, sf, with_broken=True), "json", GAME_LOG_PAYLOAD)
    _good_docs, rejected = S.split_malformed(parsed, ["gameLog"])
    return rejected.agg(F.count(F.lit(1)).alias("rejected_docs"))


def q_union_merge_schema(spark, sf):
    g = V.games(spark, sf).join(V.players(spark, sf).select("playerId", "positionCode"), "playerId", "left")
    base = ["playerId", "gameId", "teamAbbrev", "opponentAbbrev", "homeRoadFlag", "toi"]
    is_goalie = F.col("positionCode").eqNullSafe(F.lit(FL.GOALIE_CODE))
    skater_logs = g.filter(~is_goalie).select(*base, *SKATER_MEASURES)
    goalie_logs = g.filter(is_goalie).select(*base, *GOALIE_MEASURES)
    return M.union_by_name(skater_logs, goalie_logs)


# -- scoreboard ----------------------------------------------------------------

def _board_rows(spark, sf, take_while: bool) -> DataFrame:
    docs = _good(PV.scoreboard_docs(spark, sf), SCOREBOARD_PAYLOAD)
    return S.flatten_scoreboard(docs, "board", take_while=take_while)


def q_flatten_nested_scoreboard(spark, sf):
    return _board_rows(spark, sf, take_while=False).drop("new_date")


def q_take_while_scored(spark, sf):
    return _board_rows(spark, sf, take_while=True).drop("new_date")


def q_result_lines(spark, sf):
    return D.result_lines(_board_rows(spark, sf, take_while=True), "board")


def q_date_change_marks(spark, sf):
    """Marks on the stored flat table, as the digest finds it."""
    path = scratch_dir(spark, "shedule")
    K.write_snapshot(_board_rows(spark, sf, take_while=True).drop("new_date"), path)
    return D.date_marks(spark.read.parquet(path), "board").select("board", "date_pos", "game_pos", "date_play", "new_date")


def _flat_games(spark, sf) -> DataFrame:
    """The scoreboard as one flat table without a board: game, date, teams and results."""
    o = V.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("gameId"), F.expr(PV.BOARD_DATE).alias("date_play"), F.expr(PV.AWAY_NAME).alias("away_teams"),
        F.expr(PV.AWAY_SCORE).alias("away_result"), F.expr(PV.HOME_SCORE).alias("home_result"),
    )


def q_take_while_ordered(spark, sf):
    """Each date's games up to the first unscored one, over one table in date order."""
    return SG.take_while_ordered(_flat_games(spark, sf), ["date_play", "gameId"], ["date_play"], F.col("away_result").isNotNull())


def q_date_change_marks_ordered(spark, sf):
    """Marks where the date differs from the previous game's, in game order, in which dates come again."""
    return SG.change_marks_ordered(_flat_games(spark, sf), ["gameId"], ["date_play"], "new_date")


def q_results_digest(spark, sf):
    return D.digest_lines(_board_rows(spark, sf, take_while=True), "board")


def q_results_digest_text(spark, sf):
    return D.digest_text(D.digest_lines(_board_rows(spark, sf, take_while=True), "board"), "board")


def q_player_card_text_skater(spark, sf):
    cards = C.cards_from_rolled(PS.card_aggregate(*_base(spark, sf), "skater"), "skater", V.AS_OF)
    return C.card_text(cards, "skater").select("playersFIO", "card")


def q_player_card_text_goalie(spark, sf):
    cards = C.cards_from_rolled(PS.card_aggregate(*_base(spark, sf), "goalie"), "goalie", V.AS_OF)
    return C.card_text(cards, "goalie").select("playersFIO", "card")


# -- sinks (write, then read back) -------------------------------------------

def q_write_dated_partition(spark, sf):
    """Two run dates landed, then the first rerun with other data: only that
    date's partition is replaced."""
    root = scratch_dir(spark, "raw-games")
    K.write_dated_partition(V.new_games(spark, sf), root, V.RUN_DATE)
    K.write_dated_partition(V.new_games(spark, sf), root, V.NEXT_RUN_DATE)
    K.write_dated_partition(V.old_games(spark, sf), root, V.RUN_DATE)
    return K.read_dated_partition(spark, root)


def q_write_file_count(spark, sf):
    """The league's teams, a table of fixed size, written as two files."""
    path = scratch_dir(spark, "teams")
    K.write_snapshot(V.teams(spark, sf), path, num_files=2)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    return spark.read.parquet(path).withColumn("n_files", F.lit(files).cast("int"))


def q_write_snapshot(spark, sf):
    """Day-1 load, day-2 merge and a day-2 rerun through the staged swap."""
    path = scratch_dir(spark, "dwh-games")
    keys = ["playerId", "gameId"]
    K.upsert_table(spark, V.old_games(spark, sf), path, keys)
    K.upsert_table(spark, V.new_games(spark, sf), path, keys)
    return K.upsert_table(spark, V.new_games(spark, sf), path, keys)


# Warehouse partitioning of games for the partition-scoped paths: blocks of 4096
# game ids dealt to a fixed number of partitions (a stand-in for a season, which
# is a function of the id).  The number doesn't grow with the data.
GAME_BLOCKS = 16
GAME_BLOCK = ("block", f"CAST(floor(gameId / 4096) % {GAME_BLOCKS} AS INT)")


def q_upsert_partitioned(spark, sf):
    """Day-1 games, then the day-2 merge rewriting only touched partitions."""
    path = scratch_dir(spark, "dwh-games-part")
    col, expr = GAME_BLOCK
    keys = ["playerId", "gameId"]
    K.upsert_partitioned(spark, V.old_games(spark, sf).withColumn(col, F.expr(expr)), path, keys, col)
    return K.upsert_partitioned(spark, V.new_games(spark, sf).withColumn(col, F.expr(expr)), path, keys, col)


def q_incremental_skater_aggregate(spark, sf):
    """Skater aggregate kept up to date from per-partition game partials:
    full build on day 1, then only the partitions day 2 touches."""
    from . import pipeline as PL

    dwh = os.path.join(scratch_dir(spark, "incremental"), "dwh")
    col, expr = GAME_BLOCK
    keys = ["playerId", "gameId"]
    K.write_snapshot(V.teams(spark, sf), os.path.join(dwh, "teams"))
    K.write_snapshot(V.players(spark, sf), os.path.join(dwh, "players_info"))
    games_path = os.path.join(dwh, "games_info")
    K.upsert_partitioned(spark, V.old_games(spark, sf).withColumn(col, F.expr(expr)), games_path, keys, col)
    PL.refresh_aggregates(spark, dwh, GAME_BLOCK)
    K.upsert_partitioned(spark, V.new_games(spark, sf).withColumn(col, F.expr(expr)), games_path, keys, col)
    PL.refresh_aggregates(spark, dwh, GAME_BLOCK)
    return spark.read.parquet(os.path.join(dwh, "skaters_agg"))


def q_incremental_mart(spark, sf):
    """Mart kept up to date by partition: day-1 build, then the day-2 roster
    and game merges followed by a refresh of only the affected partitions."""
    from . import pipeline as PL

    dwh = os.path.join(scratch_dir(spark, "incremental-mart"), "dwh")
    col, expr = GAME_BLOCK
    keys = ["playerId", "gameId"]
    K.write_snapshot(V.teams(spark, sf), os.path.join(dwh, "teams"))
    players_path = os.path.join(dwh, "players_info")
    games_path = os.path.join(dwh, "games_info")
    K.upsert_table(spark, V.old_players(spark, sf), players_path, "playerId")
    K.upsert_partitioned(spark, V.old_games(spark, sf).withColumn(col, F.expr(expr)), games_path, keys, col)
    PL.refresh_mart(spark, dwh, GAME_BLOCK)
    K.upsert_table(spark, V.new_players(spark, sf), players_path, "playerId")
    K.upsert_partitioned(spark, V.new_games(spark, sf).withColumn(col, F.expr(expr)), games_path, keys, col)
    PL.refresh_mart(spark, dwh, GAME_BLOCK)
    return PL.read_mart(spark, dwh)


QUERIES: dict[str, Query] = {
    "scan_parquet": q_scan_parquet,
    "scan_parquet_filtered": q_scan_parquet_filtered,
    "project_columns": q_project_columns,
    "drop_columns": q_drop_columns,
    "rename_columns": q_rename_columns,
    "stamp_run_date": q_stamp_run_date,
    "full_name": q_full_name,
    "filter_not_equal_3vl": q_filter_not_equal_3vl,
    "filter_equal": q_filter_equal,
    "anti_join_single_key": q_anti_join_single_key,
    "anti_join_composite_key": q_anti_join_composite_key,
    "left_join_dimension": q_left_join_dimension,
    "role_playing_joins": q_role_playing_joins,
    "player_game_mart": q_player_game_mart,
    "upsert_single_key": q_upsert_single_key,
    "upsert_composite_key": q_upsert_composite_key,
    "upsert_first_load": q_upsert_first_load,
    "anti_join_bucketed_history": q_anti_join_bucketed_history,
    "upsert_bucketed_history": q_upsert_bucketed_history,
    "upsert_changes": q_upsert_changes,
    "skater_aggregate_by_deltas": q_skater_aggregate_by_deltas,
    "goalie_aggregate_by_deltas": q_goalie_aggregate_by_deltas,
    "discover_payload_fields": q_discover_payload_fields,
    "keep_payload_extras": q_keep_payload_extras,
    "write_file_count": q_write_file_count,
    "skater_aggregate": q_skater_aggregate,
    "goalie_aggregate": q_goalie_aggregate,
    "skater_aggregate_over_mart": q_skater_aggregate_over_mart,
    "rollup_home_road": q_rollup_home_road,
    "count_non_null": q_count_non_null,
    "first_row_per_name": q_first_row_per_name,
    "sort_by_key": q_sort_by_key,
    "preview_limit": q_preview_limit,
    "toi_seconds": q_toi_seconds,
    "named_sql_function": q_named_sql_function,
    "goalie_percentage": q_goalie_percentage,
    "age_years": q_age_years,
    "avg_toi": q_avg_toi,
    "name_link_parts": q_name_link_parts,
    "player_card_skater": q_player_card_skater,
    "player_card_goalie": q_player_card_goalie,
    "lookup_name_unsorted": q_lookup_name_unsorted,
    "lookup_clustered_keys": q_lookup_clustered_keys,
    "player_card_lookup_skater": q_player_card_lookup_skater,
    "player_card_lookup_goalie": q_player_card_lookup_goalie,
    "flatten_record_array": q_flatten_record_array,
    "flatten_map_of_arrays": q_flatten_map_of_arrays,
    "localized_default": q_localized_default,
    "flatten_keyed_array": q_flatten_keyed_array,
    "cast_id": q_cast_id,
    "semi_join_known_keys": q_semi_join_known_keys,
    "skip_malformed_payloads": q_skip_malformed_payloads,
    "rejected_payloads": q_rejected_payloads,
    "union_merge_schema": q_union_merge_schema,
    "flatten_nested_scoreboard": q_flatten_nested_scoreboard,
    "take_while_scored": q_take_while_scored,
    "result_lines": q_result_lines,
    "date_change_marks": q_date_change_marks,
    "take_while_ordered": q_take_while_ordered,
    "date_change_marks_ordered": q_date_change_marks_ordered,
    "results_digest": q_results_digest,
    "results_digest_text": q_results_digest_text,
    "player_card_text_skater": q_player_card_text_skater,
    "player_card_text_goalie": q_player_card_text_goalie,
    "write_dated_partition": q_write_dated_partition,
    "write_snapshot": q_write_snapshot,
    "upsert_partitioned": q_upsert_partitioned,
    "incremental_skater_aggregate": q_incremental_skater_aggregate,
    "incremental_mart": q_incremental_mart,
}
