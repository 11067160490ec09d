import json
import os

from pyspark.sql import functions as F

from rinkstat.plans import pipeline as PL
from rinkstat.plans.digest import digest_lines


def _w(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def _player(pid, first, last, pos):
    return {"id": pid, "headshot": f"h/{pid}.png", "firstName": {"default": first},
            "lastName": {"default": last}, "positionCode": pos, "shootsCatches": "L",
            "birthDate": "1999-01-15", "birthCity": {"default": "Town"}, "birthCountry": "XLD",
            "birthStateProvince": {"default": "North"}}


def _game(gid, team, flag, toi, **m):
    return dict({"gameId": gid, "teamAbbrev": team, "opponentAbbrev": "BET", "homeRoadFlag": flag,
                 "commonName": {"default": team}, "opponentCommonName": {"default": "Beta"}, "toi": toi}, **m)


def _land(root, day):
    _w(f"{root}/teams.json", {"data": [{"id": 1, "fullName": "Alpha Club", "triCode": "ALP"},
                                       {"id": 2, "fullName": "Beta Club", "triCode": "BET"}]})
    if day == 1:
        _w(f"{root}/roster/ALP.json", {"forwards": [_player(11, "Ann", "Lee", "C")],
                                       "goalies": [_player(13, "Gus", "Olm", "G")]})
        _w(f"{root}/roster/BET.json", "<html>not json</html>")
        _w(f"{root}/roster/ZZZ.json", {"forwards": [_player(77, "Zed", "Unk", "C")]})
        _w(f"{root}/gamelog/11.json", {"gameLog": [_game(1, "ALP", "H", "10:00", goals=1, points=1),
                                                  _game(2, "ALP", "R", "12:30", goals=0, points=2),
                                                  _game(None, "ALP", "R", "01:00", goals=5)]})
        _w(f"{root}/gamelog/13.json", {"gameLog": [_game(1, "ALP", "H", "60:00", shotsAgainst=20,
                                                         goalsAgainst=1, gamesStarted=1, shutouts=0)]})
        _w(f"{root}/gamelog/77.json", {"gameLog": [_game(1, "ZZZ", "H", "01:00", goals=9)]})
        _w(f"{root}/scoreboard.json", {"gamesByDate": [
            {"date": "2024-01-01", "games": [
                {"awayTeam": {"name": {"default": "ALP"}, "score": 2}, "homeTeam": {"name": {"default": "BET"}, "score": 1}},
                {"awayTeam": {"name": {"default": "BET"}}, "homeTeam": {"name": {"default": "ALP"}}}]},
            {"date": "2024-01-02", "games": [
                {"awayTeam": {"name": {"default": "BET"}, "score": 0}, "homeTeam": {"name": {"default": "ALP"}, "score": 3}}]}]})
    else:
        _w(f"{root}/roster/ALP.json", {"forwards": [_player(12, "Bo", "Ray", "C")]})
        os.remove(f"{root}/roster/BET.json")
        _w(f"{root}/roster/BET.json", {"forwards": [_player(11, "Ann", "Lee", "C")]})
        _w(f"{root}/gamelog/11.json", {"gameLog": [_game(2, "ALP", "R", "12:30", goals=1, points=2),
                                                  _game(3, "BET", "H", "15:00", goals=2, points=2)]})
        os.remove(f"{root}/gamelog/13.json")
        _w(f"{root}/gamelog/12.json", {"gameLog": [_game(3, "ALP", "R", "05:00", goals=0, points=0)]})


def test_daily_batches_end_to_end(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    players, rejected = PL.players_batch(spark, land, raw, dwh, "2024-01-01")
    assert sorted(r.playerId for r in players.collect()) == [11, 13]
    assert sorted((r.entity, r.kind) for r in rejected.collect()) == [("11", "null gameId"), ("BET", "roster")]
    PL.mart_and_aggregates(spark, dwh)
    sk = {(r.playerId, r.homeRoadFlag): r for r in spark.read.parquet(f"{dwh}/skaters_agg").collect()}
    assert set(sk) == {(11, "H"), (11, "R")} and sk[(11, "R")].toi == 750
    gk = spark.read.parquet(f"{dwh}/goalies_agg").collect()
    assert [(r.playerId, r.shotsAgainst, r.gamesCNT) for r in gk] == [(13, 20, 1)]

    _land(land, 2)
    PL.players_batch(spark, land, raw, dwh, "2024-01-02")
    PL.players_batch(spark, land, raw, dwh, "2024-01-02")  # rerun of the same day
    info = {r.playerId: r for r in spark.read.parquet(f"{dwh}/players_info").collect()}
    assert set(info) == {11, 12, 13}
    assert info[11].triCodeCurrent == "BET" and info[11].updatedDt == "2024-01-02"
    assert info[13].updatedDt == "2024-01-01"
    games = sorted((r.playerId, r.gameId, r.goals) for r in spark.read.parquet(f"{dwh}/games_info").collect())
    assert games == [(11, 1, 1), (11, 2, 1), (11, 3, 2), (12, 3, 0), (13, 1, None)]
    PL.mart_and_aggregates(spark, dwh)
    mart = spark.read.parquet(f"{dwh}/players_games_datamart")
    assert mart.count() == 5
    sk = {(r.playerId, r.teamAbbrev, r.homeRoadFlag): r for r in spark.read.parquet(f"{dwh}/skaters_agg").collect()}
    assert sk[(11, "BET", "H")].currentTeamFullName == "Beta Club" and sk[(11, "BET", "H")].goals == 2

    sched = PL.schedule_batch(spark, land, raw, dwh, "2024-01-02")
    text = "".join(r.line for r in digest_lines(sched, "board").orderBy("date_pos", "game_pos").collect())
    assert text == "2024-01-01 ALP 2:1 BET.\n\n2024-01-02 BET 0:3 ALP.\n"


def test_cards_from_stored_aggregate(spark, tmp_path):
    from rinkstat.plans.cards import cards_from_aggregate

    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    PL.players_batch(spark, land, raw, dwh, "2024-01-01")
    PL.mart_and_aggregates(spark, dwh)
    agg = spark.read.parquet(f"{dwh}/skaters_agg")
    card = cards_from_aggregate(agg, "skater", "2024-06-30", name="Ann Lee")
    plan = card._jdf.queryExecution().executedPlan().toString()
    assert "playersFIO" in plan.split("PushedFilters")[1].split("]")[0]
    r = card.first()
    assert (r.playerId, r.gamesCNT, r.goals, r.points, r.toi, r.age) == (11, 2, 1, 3, 1350, 25)
    goalie = cards_from_aggregate(spark.read.parquet(f"{dwh}/goalies_agg"), "goalie", "2024-06-30", "Gus Olm").first()
    assert (goalie.perc_goals, goalie.save_pct) == (95.24, 95.0)


def test_partitioned_games_warehouse(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    part = ("block", "CAST(gameId DIV 2 AS INT)")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    PL.players_batch(spark, land, raw, dwh, "2024-01-01", games_partition=part)
    _land(land, 2)
    PL.players_batch(spark, land, raw, dwh, "2024-01-02", games_partition=part)
    assert sorted(n for n in os.listdir(f"{dwh}/games_info") if n.startswith("block=")) == ["block=0", "block=1"]
    games = sorted((r.playerId, r.gameId, r.goals) for r in spark.read.parquet(f"{dwh}/games_info").collect())
    assert games == [(11, 1, 1), (11, 2, 1), (11, 3, 2), (12, 3, 0), (13, 1, None)]
    PL.mart_and_aggregates(spark, dwh)
    assert spark.read.parquet(f"{dwh}/players_games_datamart").count() == 5


def test_bad_teams_payload_keeps_the_table(spark, tmp_path):
    import pytest

    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    _w(f"{land}/teams.json", '{"data": [{"id": 1, ')
    with pytest.raises(ValueError):
        PL.teams_batch(spark, land, raw, dwh, "2024-01-02")
    assert spark.read.parquet(f"{dwh}/teams").count() == 2


def test_incremental_aggregates_equal_full_rebuild(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    part = ("block", "CAST(gameId DIV 2 AS INT)")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    PL.players_batch(spark, land, raw, dwh, "2024-01-01", games_partition=part)
    PL.refresh_aggregates(spark, dwh, part)
    _land(land, 2)
    PL.players_batch(spark, land, raw, dwh, "2024-01-02", games_partition=part)
    before = sorted(os.listdir(f"{dwh}/_game_partials/block=0"))
    PL.refresh_aggregates(spark, dwh, part)
    inc = {t: sorted(map(tuple, spark.read.parquet(f"{dwh}/{t}").collect())) for t in ("skaters_agg", "goalies_agg")}
    PL.mart_and_aggregates(spark, dwh)  # full rebuild from games_info
    full = {t: sorted(map(tuple, spark.read.parquet(f"{dwh}/{t}").collect())) for t in ("skaters_agg", "goalies_agg")}
    assert inc == full and inc["skaters_agg"]
    # day 2 touched games 2 and 3 (blocks 1); block 0 (game 1) was not rewritten
    assert sorted(os.listdir(f"{dwh}/_game_partials/block=0")) == before


def test_incremental_mart_equals_full_rebuild(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    part = ("block", "CAST(gameId DIV 2 AS INT)")
    _land(land, 1)
    # player 13 also played game 4 (block 2); nothing about 13 changes on day 2
    _w(f"{land}/gamelog/13.json", {"gameLog": [
        _game(1, "ALP", "H", "60:00", shotsAgainst=20, goalsAgainst=1, gamesStarted=1, shutouts=0),
        _game(4, "ALP", "R", "60:00", shotsAgainst=10, goalsAgainst=2, gamesStarted=1, shutouts=0)]})
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    PL.players_batch(spark, land, raw, dwh, "2024-01-01", games_partition=part)
    PL.refresh_mart(spark, dwh, part)
    untouched = sorted(os.listdir(f"{dwh}/players_games_datamart/block=2"))
    _land(land, 2)  # player 11 moves to BET (blocks 0 and 1), games 2 and 3 (block 1) arrive
    PL.players_batch(spark, land, raw, dwh, "2024-01-02", games_partition=part)
    PL.refresh_mart(spark, dwh, part)
    inc = PL.read_mart(spark, dwh)
    cols = sorted(inc.columns)
    inc_rows = sorted(map(tuple, inc.select(*cols).collect()), key=str)
    from rinkstat.plans.mart import player_game_mart

    full = player_game_mart(spark.read.parquet(f"{dwh}/games_info"), spark.read.parquet(f"{dwh}/players_info"),
                            spark.read.parquet(f"{dwh}/teams"))
    full_rows = sorted(map(tuple, full.withColumn("block", F.expr(part[1])).select(*cols).collect()), key=str)
    assert inc_rows == full_rows and len(inc_rows) == 6
    assert sorted(os.listdir(f"{dwh}/players_games_datamart/block=2")) == untouched
    moved = [r for r in inc.collect() if r.playerId == 11]
    assert {r.currentTeamFullName for r in moved} == {"Beta Club"}


PART = ("block", "CAST(gameId DIV 2 AS INT)")


def _rows(df):
    cols = sorted(c for c in df.columns if c != "block")
    return sorted(map(str, df.select(*cols).collect()))


def _full(spark, dwh):
    from rinkstat.plans.mart import player_game_mart

    return player_game_mart(*(spark.read.parquet(f"{dwh}/{t}") for t in ("games_info", "players_info", "teams")))


def test_missed_refresh_day_is_caught_up(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    PL.players_batch(spark, land, raw, dwh, "2024-01-01", games_partition=PART)
    PL.refresh_aggregates(spark, dwh, PART)
    PL.refresh_mart(spark, dwh, PART)
    _w(f"{land}/gamelog/11.json", {"gameLog": [_game(4, "ALP", "H", "09:00", goals=3)]})
    PL.players_batch(spark, land, raw, dwh, "2024-01-02", games_partition=PART)  # no refresh on this day
    _w(f"{land}/gamelog/11.json", {"gameLog": [_game(6, "ALP", "H", "08:00", goals=1)]})
    PL.players_batch(spark, land, raw, dwh, "2024-01-03", games_partition=PART)
    PL.refresh_aggregates(spark, dwh, PART)
    PL.refresh_mart(spark, dwh, PART)
    assert _rows(PL.read_mart(spark, dwh)) == _rows(_full(spark, dwh))
    inc = {t: _rows(spark.read.parquet(f"{dwh}/{t}")) for t in ("skaters_agg", "goalies_agg")}
    PL.mart_and_aggregates(spark, dwh)
    assert inc == {t: _rows(spark.read.parquet(f"{dwh}/{t}")) for t in ("skaters_agg", "goalies_agg")}
    assert spark.read.parquet(f"{dwh}/skaters_agg").agg(F.sum("gamesCNT")).first()[0] == 4


def test_restamped_roster_rebuilds_nothing(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    PL.players_batch(spark, land, raw, dwh, "2024-01-01", games_partition=PART)
    PL.refresh_mart(spark, dwh, PART)
    files = lambda: {p: sorted(os.listdir(f"{dwh}/players_games_datamart/{p}")) for p in os.listdir(f"{dwh}/players_games_datamart") if "=" in p}
    before = files()
    games = spark.read.parquet(f"{dwh}/games_info")
    for f in os.listdir(f"{land}/gamelog"):
        os.remove(f"{land}/gamelog/{f}")
    _w(f"{land}/gamelog/99.json", {"gameLog": []})
    PL.players_batch(spark, land, raw, dwh, "2024-01-02", games_partition=PART)
    PL.refresh_mart(spark, dwh, PART)
    assert files() == before and games.count() == 4 - 1
    assert {r.updatedDt for r in PL.read_mart(spark, dwh).collect()} == {"2024-01-02"}
    assert _rows(PL.read_mart(spark, dwh)) == _rows(_full(spark, dwh))


def test_truncated_scoreboard_keeps_the_table(spark, tmp_path):
    import pytest

    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    assert PL.schedule_batch(spark, land, raw, dwh, "2024-01-01").count() == 2
    _w(f"{land}/scoreboard.json", '{"gamesByDate": [{"date": ')
    with pytest.raises(ValueError, match="malformed"):
        PL.schedule_batch(spark, land, raw, dwh, "2024-01-02")
    assert spark.read.parquet(f"{dwh}/shedule").count() == 2
    _w(f"{land}/scoreboard.json", '{"gamesByDate": []}')
    assert PL.schedule_batch(spark, land, raw, dwh, "2024-01-03").count() == 0  # valid and empty


def test_error_bodies_and_bad_ids_are_counted(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    _w(f"{land}/gamelog/13.json", '{"error": "not found"}')
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    _, rejected = PL.players_batch(spark, land, raw, dwh, "2024-01-01")
    assert sorted((r.entity, r.kind) for r in rejected.collect()) == [
        ("11", "null gameId"), ("13", "gamelog"), ("BET", "roster")
    ]


def test_player_on_two_rosters_is_kept_once(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    os.remove(f"{land}/roster/BET.json")
    _w(f"{land}/roster/BET.json", {"forwards": [_player(11, "Ann", "Lee", "C")]})
    PL.teams_batch(spark, land, raw, dwh, "2024-01-01")
    info, _ = PL.players_batch(spark, land, raw, dwh, "2024-01-01", dedupe_by="updatedDt")
    assert sorted(r.playerId for r in info.collect()) == [11, 13]


def test_mart_of_the_current_roster_is_read_without_a_join(spark, tmp_path):
    from rinkstat.schemas import GAMES_INFO_TABLE, PLAYERS_INFO_TABLE
    from rinkstat.sinks import parquet as K

    dwh = str(tmp_path / "dwh")
    player = lambda p, day, team="ALP": (p, "h", "F", f"L{p}", "C", "L", None, "c", "x", None, team, day)
    roster = [player(1, "2024-01-01"), player(1, "2024-01-03"), player(2, None), player(2, "2024-01-02"), player(None, "2024-01-09"), player(4, None)]
    empty = {f.name: None for f in GAMES_INFO_TABLE.fields}
    games = [(*(empty | {"playerId": p, "gameId": g, "teamAbbrev": "ALP"}).values(), g // 2) for p in (1, 2, 3, 4, None) for g in range(4)]
    game_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GAMES_INFO_TABLE.fields) + ", block int"
    K.write_snapshot(spark.createDataFrame([(1, "Alpha", "ALP")], "id int, fullName string, triCode string"), f"{dwh}/teams")
    K.write_snapshot(spark.createDataFrame(roster, PLAYERS_INFO_TABLE), f"{dwh}/players_info")
    K.write_snapshot_partitioned(spark.createDataFrame(games, game_schema), f"{dwh}/games_info", "block")
    PL.refresh_mart(spark, dwh, PART)

    def joins():
        return PL.read_mart(spark, dwh)._jdf.queryExecution().optimizedPlan().toString().count("Join")

    def stamps():
        return sorted({(str(r.playerId), str(r.updatedDt)) for r in PL.read_mart(spark, dwh).collect()})

    assert joins() == 0 and PL.read_mart(spark, dwh).count() == 28
    assert stamps() == [("1", "2024-01-03"), ("2", "2024-01-02"), ("3", "None"), ("4", "None"), ("None", "None")]
    # The roster is stamped anew: nothing is rebuilt, so every partition meets it.
    K.write_snapshot(spark.createDataFrame([(*r[:-1], "2024-02-01") for r in roster], PLAYERS_INFO_TABLE), f"{dwh}/players_info")
    PL.refresh_mart(spark, dwh, PART)
    assert joins() == 1 and ("4", "2024-02-01") in stamps() and PL.read_mart(spark, dwh).count() == 28
    # One more game of block 0: that partition is rebuilt and read as it is, the other one meets the roster.
    more = spark.createDataFrame([(*(empty | {"playerId": 4, "gameId": 1, "teamAbbrev": "ALP", "goals": 5}).values(), 0)], game_schema)
    K.upsert_partitioned(spark, more, f"{dwh}/games_info", ["playerId", "gameId"], "block")
    PL.refresh_mart(spark, dwh, PART)
    mart = PL.read_mart(spark, dwh)
    assert joins() == 1 and mart._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
    assert mart.count() == 28 and {r.updatedDt for r in mart.filter("playerId = 4").collect()} == {"2024-02-01"}
