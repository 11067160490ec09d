"""The three daily/yearly batches as Spark job chains (no scheduler).

Each function is one run for one run date ``ds``; the caller (any scheduler)
decides when.  Hand-off between stages is parquet, as in a warehouse:

  landing/<entity>/...json  --ingest-->  raw/<table>/ds=<ds>  --merge-->  dwh/<table>

``landing_root``, ``raw_root`` and ``dwh_root`` are caller-supplied paths on
a shared file system.  No data rows are collected to the driver: the
known-key driving sets (teams -> rosters, players -> game logs) are
semi-joins on the file name, not driver loops.  The driver only sees
metadata (the partition values a merge touches, whether the teams payload
is empty).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import semi_join
from ..operators.merge import split_null_keys
from ..schemas import GAME_LOG_PAYLOAD, ROSTER_PAYLOAD, SCOREBOARD_PAYLOAD, TEAMS_PAYLOAD
from ..session import ensure_checkpoint_dir
from ..sinks import parquet as K
from ..sinks.jdbc import write_jdbc
from ..sources import payloads as S
from .mart import player_game_mart
from .player_stats import PLAYER_GRAIN, game_partials, player_aggregate

TEAM_COLUMNS = ["id", "fullName", "triCode"]


def _p(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


def teams_batch(spark: SparkSession, landing_root: str, raw_root: str, dwh_root: str, ds: str) -> DataFrame:
    """teams.json -> raw/teams/ds=.. -> dwh/teams (id, fullName, triCode).

    Every other batch is driven by this table, so a malformed or empty teams
    payload fails the run (for the scheduler to retry) instead of replacing
    the table with nothing; the current table is left as it is.
    """
    docs = S.read_payload_files(spark, _p(landing_root, "teams.json"), TEAMS_PAYLOAD)
    good, _ = S.split_malformed(docs, ["data"])
    teams = S.flatten_record_array(good, "data").select(
        F.col("id").cast("int").alias("id"), "fullName", "triCode"
    )
    if teams.isEmpty():
        raise ValueError(f"teams payload for {ds} is malformed or empty; dwh/teams left unchanged")
    K.write_dated_partition(teams, _p(raw_root, "teams"), ds)
    raw = K.read_dated_partition(spark, _p(raw_root, "teams"), ds).select(*TEAM_COLUMNS)
    K.write_snapshot(raw, _p(dwh_root, "teams"))
    return spark.read.parquet(_p(dwh_root, "teams"))


def players_batch(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    dwh_root: str,
    ds: str,
    dedupe_by: str | None = None,
    games_partition: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rosters of known teams -> players_info (upsert on playerId); then game
    logs of known players -> games_info (upsert on playerId, gameId).

    Rows with a NULL key are not merged (they could never be replaced); they
    are returned with the rejected payloads.  ``dedupe_by`` keeps one roster
    row per player (e.g. a player listed by two teams on the same day).
    ``games_partition=(column, sql_expr)`` keeps ``games_info`` partitioned by
    a function of the game id (e.g. ``("season", "CAST(gameId DIV 1000000 AS
    INT)")``) so a day's merge rewrites only the seasons it touches instead of
    the whole table.  Returns (players_info, rejected)."""
    teams = spark.read.parquet(_p(dwh_root, "teams"))
    rosters = S.read_payload_files(spark, _p(landing_root, "roster"), ROSTER_PAYLOAD)
    rosters = semi_join(rosters.withColumn("triCode", F.col(S.ENTITY_COLUMN)), teams, "triCode")
    good, rejected_rosters = S.split_malformed(rosters)
    records = S.flatten_map_of_arrays(good, "value", carry=["triCode"])
    players = S.roster_to_players_info(records, "triCode", ds)
    K.write_dated_partition(players, _p(raw_root, "players_info"), ds)
    new_players = K.read_dated_partition(spark, _p(raw_root, "players_info"), ds).drop(K.DS_COLUMN)
    new_players, null_players = split_null_keys(new_players, "playerId")
    players_info = K.upsert_table(
        spark, new_players, _p(dwh_root, "players_info"), "playerId", dedupe_by=dedupe_by
    )

    logs = S.read_payload_files(spark, _p(landing_root, "gamelog"), GAME_LOG_PAYLOAD)
    logs = semi_join(logs.withColumn("playerId", F.col(S.ENTITY_COLUMN).try_cast("bigint")), players_info, "playerId")
    good_logs, rejected_logs = S.split_malformed(logs, ["gameLog"])
    games = S.game_log_to_games_info(S.flatten_keyed_array(good_logs, "gameLog", {"playerId": "playerId"}))
    K.write_dated_partition(games, _p(raw_root, "games_info"), ds)
    new_games = K.read_dated_partition(spark, _p(raw_root, "games_info"), ds).drop(K.DS_COLUMN)
    new_games, null_games = split_null_keys(new_games, ["playerId", "gameId"])
    if games_partition is None:
        K.upsert_table(spark, new_games, _p(dwh_root, "games_info"), ["playerId", "gameId"])
    else:
        column, expr = games_partition
        K.upsert_partitioned(
            spark, new_games.withColumn(column, F.expr(expr)), _p(dwh_root, "games_info"),
            ["playerId", "gameId"], column,
        )
    rejected = (
        rejected_rosters.select(S.ENTITY_COLUMN).withColumn("kind", F.lit("roster"))
        .unionByName(rejected_logs.select(S.ENTITY_COLUMN).withColumn("kind", F.lit("gamelog")))
        .unionByName(null_players.select(F.col("triCodeCurrent").alias(S.ENTITY_COLUMN), F.lit("null playerId").alias("kind")))
        .unionByName(null_games.select(F.col("playerId").cast("string").alias(S.ENTITY_COLUMN), F.lit("null gameId").alias("kind")))
    )
    return players_info, rejected


def mart_and_aggregates(spark: SparkSession, dwh_root: str, num_files: int | None = None) -> None:
    """dwh tables -> players_games_datamart, skaters_agg, goalies_agg.

    The game partials (one pass over the fact table) are written once to the
    shared checkpoint folder and feed both aggregates, which cuts lineage and
    spares a second scan of the facts.
    """
    teams = spark.read.parquet(_p(dwh_root, "teams"))
    players = spark.read.parquet(_p(dwh_root, "players_info"))
    games = spark.read.parquet(_p(dwh_root, "games_info"))
    K.write_snapshot(player_game_mart(games, players, teams), _p(dwh_root, "players_games_datamart"), num_files)
    ensure_checkpoint_dir(spark)
    partials = game_partials(games).checkpoint(eager=True)
    for kind, table in (("skater", "skaters_agg"), ("goalie", "goalies_agg")):
        agg = player_aggregate(partials, players, teams, kind, pre_aggregated=True)
        K.write_snapshot(agg, _p(dwh_root, table), num_files, sort_by=["playerId"])


PARTIALS_TABLE = "_game_partials"
PARTIALS_BUILT = "_game_partials_built"


def refresh_aggregates(
    spark: SparkSession,
    dwh_root: str,
    games_partition: tuple[str, str],
    num_files: int | None = None,
) -> None:
    """skaters_agg / goalies_agg from game partials kept per partition.

    The partials (count and sums per player, team, home/road and partition)
    depend only on ``games_info``.  A stored marker says from which files of
    each ``games_info`` partition they were built; a run recomputes just the
    partitions that differ, however many merges it missed.  The marker is
    written last, so an interrupted run is done again.  The aggregates are then
    re-derived from the partials table (one row per group, not per game) joined
    to the current player and team dimensions, so a changed current team still
    reaches every season.  ``games_partition`` is the ``(column, sql_expr)``
    given to :func:`players_batch`.
    """
    games_path, partials_path = _p(dwh_root, "games_info"), _p(dwh_root, PARTIALS_TABLE)
    column = games_partition[0]
    grain = PLAYER_GRAIN + [column]
    versions = K.partition_versions(spark, games_path)
    games = spark.read.parquet(games_path)
    players = spark.read.parquet(_p(dwh_root, "players_info"))
    teams = spark.read.parquet(_p(dwh_root, "teams"))
    if K.table_exists(spark, partials_path):
        changed = K.changed_partitions(spark, versions, _p(dwh_root, PARTIALS_BUILT))
        if changed:
            subset = games.filter(K.in_partition_folders(column, changed))
            K.replace_partitions(game_partials(subset, grain), partials_path, column, gather=False)
    else:
        K.write_snapshot_partitioned(game_partials(games, grain), partials_path, column, gather=False)
    K.write_versions(spark, versions, _p(dwh_root, PARTIALS_BUILT))
    partials = spark.read.parquet(partials_path)
    for kind, table in (("skater", "skaters_agg"), ("goalie", "goalies_agg")):
        agg = player_aggregate(partials, players, teams, kind, pre_aggregated=True)
        K.write_snapshot(agg, _p(dwh_root, table), num_files, sort_by=["playerId"])


MART_TABLE = "players_games_datamart"
MART_BUILT = "_mart_built"
MART_PLAYERS = "_mart_players"
MART_TEAMS = "_mart_teams"
#: By which roster each partition of the mart was stamped.
MART_STAMPED = "_mart_stamped"
STAMP = "updatedDt"


def _changed_keys(current: DataFrame, previous: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose row in ``current`` is new or differs from ``previous``
    (NULL-safe); both are dimension-sized."""
    cols = [c for c in current.columns if c not in ignore]
    return current.select(*cols).exceptAll(previous.select(*cols)).select(key).distinct()


def refresh_mart(spark: SparkSession, dwh_root: str, games_partition: tuple[str, str]) -> None:
    """Keep ``players_games_datamart`` partitioned like ``games_info`` and
    rebuild only the partitions that can have changed.

    A partition changes when its ``games_info`` files differ from those the
    mart was built from (a stored marker, so no merge is ever missed), or when
    it holds a game of a player whose dimension row changed since the last
    build (the mart copies current player attributes into every game).  Changed
    players come from comparing ``players_info`` with the copy the mart was
    built from, a dimension-sized comparison; a teams change (yearly) or a
    first run rebuilds everything.  The daily stamp ``updatedDt`` doesn't count
    as a change: the stored one is that of the partition's last rebuild, and
    :func:`read_mart` puts in the current one.  Which roster a partition was
    stamped by is stored too, so that those of the current one are read as they are.
    """
    column = games_partition[0]
    games_path, mart_path = _p(dwh_root, "games_info"), _p(dwh_root, MART_TABLE)
    snap_players, snap_teams, built, stamped = (_p(dwh_root, t) for t in (MART_PLAYERS, MART_TEAMS, MART_BUILT, MART_STAMPED))
    roster = K.table_version(spark, _p(dwh_root, "players_info"))
    versions = K.partition_versions(spark, games_path)
    games = spark.read.parquet(games_path)
    players = spark.read.parquet(_p(dwh_root, "players_info"))
    teams = spark.read.parquet(_p(dwh_root, "teams"))
    full = not all(K.table_exists(spark, p) for p in (mart_path, snap_players, snap_teams))
    if not full:
        full = not _changed_keys(teams, spark.read.parquet(snap_teams), "triCode").isEmpty()
    before = K.partition_versions(spark, mart_path) if K.table_exists(spark, mart_path) else {}
    latest = players.filter("playerId IS NOT NULL").withColumn(STAMP, F.max(STAMP).over(Window.partitionBy("playerId")))
    # The join has dealt the rows: gathering them by partition would shuffle the wide rows a second time.
    if full:
        K.write_snapshot_partitioned(player_game_mart(games, latest, teams), mart_path, column, gather=False)
    else:
        moved = _changed_keys(players, spark.read.parquet(snap_players), "playerId", (STAMP,))
        by_players = games.select("playerId", column).join(moved, "playerId", "left_semi")
        touched = K.in_partitions(column, K.touched_partition_values(by_players, column))
        changed = K.in_partition_folders(column, K.changed_partitions(spark, versions, built))
        subset = games.filter(touched | changed)
        K.replace_partitions(player_game_mart(subset, latest, teams), mart_path, column, gather=False)
    after = K.partition_versions(spark, mart_path)
    earlier = K.read_versions(spark, stamped)
    K.write_versions(spark, {p: roster if before.get(p) != v else earlier.get(p, "") for p, v in after.items()}, stamped)
    K.write_snapshot(players, snap_players)
    K.write_snapshot(teams, snap_teams)
    K.write_versions(spark, versions, built)


def read_mart(spark: SparkSession, dwh_root: str) -> DataFrame:
    """The stored mart with each player's current ``updatedDt`` (the latest, if the roster holds a player twice).

    Partitions stamped by the current roster hold it already; only the others meet the roster.
    """
    mart = spark.read.parquet(_p(dwh_root, MART_TABLE))
    players_path = _p(dwh_root, "players_info")
    roster = K.table_version(spark, players_path)
    stamped = K.read_versions(spark, _p(dwh_root, MART_STAMPED))
    present = K.partition_versions(spark, _p(dwh_root, MART_TABLE))
    current = [p for p in present if stamped.get(p) == roster]
    if present and len(current) == len(present):
        return mart
    stamps = spark.read.parquet(players_path).groupBy("playerId").agg(F.max(STAMP).alias("_now"))
    now = F.coalesce(F.col("_now"), F.col(STAMP))
    restamped = lambda rows: rows.join(stamps, "playerId", "left").withColumn(STAMP, now).select(*mart.columns)
    if not current:
        return restamped(mart)
    column = current[0].split("=", 1)[0]
    own, others = (mart.filter(K.in_partition_folders(column, names)) for names in (current, set(present) - set(current)))
    return own.unionByName(restamped(others))


def schedule_batch(spark: SparkSession, landing_root: str, raw_root: str, dwh_root: str, ds: str) -> DataFrame:
    """scoreboard.json -> take-while rows -> raw/shedule/ds=.. -> dwh/shedule
    (replaced, not merged), keeping the display positions.

    A malformed scoreboard fails the run before anything is written; a valid
    one without games is legal and empties the table.
    """
    docs = S.read_payload_files(spark, _p(landing_root, "scoreboard.json"), SCOREBOARD_PAYLOAD)
    good, rejected = S.split_malformed(docs)
    if not rejected.isEmpty():
        raise ValueError(f"scoreboard payload for {ds} is malformed; dwh/shedule left unchanged")
    rows = S.flatten_scoreboard(good.withColumnRenamed(S.ENTITY_COLUMN, "board"), "board")
    K.write_dated_partition(rows, _p(raw_root, "shedule"), ds)
    raw = K.read_dated_partition(spark, _p(raw_root, "shedule"), ds).drop(K.DS_COLUMN)
    K.write_snapshot(raw, _p(dwh_root, "shedule"))
    return spark.read.parquet(_p(dwh_root, "shedule"))


SERVING_TABLES = ("skaters_agg", "goalies_agg", "players_games_datamart", "shedule")


def publish(
    spark: SparkSession,
    dwh_root: str,
    url: str,
    schema: str = "public",
    tables: tuple[str, ...] = SERVING_TABLES,
    games_partition: tuple[str, str] | None = None,
    num_partitions: int = 8,
    **jdbc_options,
) -> None:
    """Overwrite the serving tables in a relational database over JDBC.

    Connection settings come from the caller (``user``, ``password``,
    ``driver`` ... as in :func:`rinkstat.sinks.jdbc.write_jdbc`);
    ``num_partitions`` bounds the connections.  The partition column of a
    partitioned mart is the warehouse's own and isn't published.
    """
    for table in tables:
        if table == MART_TABLE and games_partition is not None:
            df = read_mart(spark, dwh_root).drop(games_partition[0])
        else:
            df = spark.read.parquet(_p(dwh_root, table))
        write_jdbc(df, url, f"{schema}.{table}" if schema else table, num_partitions=num_partitions, **jdbc_options)
