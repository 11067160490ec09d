import json
import os
import random

from pyspark.sql import functions as F

from rinkstat.operators.joins import semi_join
from rinkstat.schemas import GAME_LOG_PAYLOAD, ROSTER_PAYLOAD, SCOREBOARD_PAYLOAD, TEAMS_PAYLOAD
from rinkstat.sources import payloads as S


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def _player(pid, first, last, pos, city={"default": "Springfield"}, prov={"default": "North"}):
    return {
        "id": pid, "headshot": f"h/{pid}.png", "firstName": first, "lastName": last,
        "positionCode": pos, "shootsCatches": "L", "birthDate": "2000-02-29",
        "birthCity": city, "birthCountry": "XLD", "birthStateProvince": prov,
    }


def test_teams_payload(spark, tmp_path):
    _write(str(tmp_path / "teams.json"), {"data": [
        {"id": 1, "fullName": "Alpha Club", "triCode": "ALP"},
        {"id": 2, "fullName": "Beta Club", "triCode": "BET"},
    ]})
    docs = S.read_payload_files(spark, str(tmp_path / "teams.json"), TEAMS_PAYLOAD)
    good, bad = S.split_malformed(docs)
    rows = sorted(tuple(r) for r in S.flatten_record_array(good, "data").collect())
    assert rows == [(1, "Alpha Club", "ALP"), (2, "Beta Club", "BET")]
    assert bad.count() == 0


def test_roster_map_of_arrays_and_localized(spark, tmp_path):
    root = tmp_path / "roster"
    _write(str(root / "ALP.json"), {
        "forwards": [
            _player(11, {"default": "Ann"}, {"default": "Lee", "fr": "Li"}, "C"),
            _player(12, "PlainString", {"cs": "Novak"}, "L", prov=None),
        ],
        "goalies": [_player(13, {"default": "Gus"}, {"default": "Olm"}, "G")],
    })
    _write(str(root / "BET.json"), '{"defensemen": [{"id": 21, "firstName": ')  # not JSON
    _write(str(root / "GAM.json"), {"defensemen": [_player(31, {"default": "Dee"}, {"default": "Fox"}, None)]})
    docs = S.read_payload_files(spark, str(root), ROSTER_PAYLOAD)
    good, bad = S.split_malformed(docs)
    assert [r.entity for r in bad.collect()] == ["BET"]
    recs = S.flatten_map_of_arrays(good, "value", carry=[S.ENTITY_COLUMN])
    players = S.roster_to_players_info(recs, S.ENTITY_COLUMN, "2024-01-01")
    got = {r.playerId: r for r in players.collect()}
    assert set(got) == {11, 12, 13, 31}
    assert (got[11].firstName, got[11].lastName, got[11].triCodeCurrent) == ("Ann", "Lee", "ALP")
    assert (got[12].firstName, got[12].lastName, got[12].birthStateProvince) == ("", "", "")
    assert got[31].positionCode is None and got[31].triCodeCurrent == "GAM"
    assert str(got[13].birthDate) == "2000-02-29" and got[13].updatedDt == "2024-01-01"


def test_game_logs_keyed_semi_join_and_gaps(spark, tmp_path):
    root = tmp_path / "gamelog"
    skater = {"gameId": 1001, "teamAbbrev": "ALP", "opponentAbbrev": "BET", "homeRoadFlag": "H",
              "commonName": {"default": "Alpha"}, "opponentCommonName": {"default": "Beta"},
              "toi": "10:05", "goals": 1, "points": 2, "plusMinus": 1, "shots": 3}
    goalie = {"gameId": 1002, "teamAbbrev": "ALP", "opponentAbbrev": "BET", "homeRoadFlag": "R",
              "commonName": {"default": "Alpha"}, "opponentCommonName": {"default": "Beta"},
              "toi": "60:00", "gamesStarted": 1, "shotsAgainst": 30, "goalsAgainst": 2, "shutouts": 0}
    _write(str(root / "11.json"), {"gameLog": [skater, dict(skater, gameId=1003, homeRoadFlag="R")]})
    _write(str(root / "13.json"), {"gameLog": [goalie]})
    _write(str(root / "99.json"), {"gameLog": [dict(skater, gameId=2000)]})  # unknown player
    known = spark.createDataFrame([(11,), (13,), (12,)], "playerId bigint")  # 12 has no log file
    docs = S.read_payload_files(spark, str(root), GAME_LOG_PAYLOAD)
    docs = docs.withColumn("playerId", F.col(S.ENTITY_COLUMN).cast("bigint"))
    good, _ = S.split_malformed(semi_join(docs, known, "playerId"))
    rows = S.game_log_to_games_info(S.flatten_keyed_array(good, "gameLog", {"playerId": "playerId"}))
    got = {(r.playerId, r.gameId): r for r in rows.collect()}
    assert set(got) == {(11, 1001), (11, 1003), (13, 1002)}
    assert got[(13, 1002)].plusMinus is None and got[(13, 1002)].shotsAgainst == 30
    assert got[(11, 1001)].shotsAgainst is None and got[(11, 1001)].goals == 1
    assert "commonName" not in rows.columns and dict(rows.dtypes)["gameId"] == "bigint"


def _board(dates):
    def side(name, score):
        s = {"name": {"default": name}}
        if score is not None:
            s["score"] = score
        return s
    return {"gamesByDate": [
        {"date": d, "games": [{"awayTeam": side(a, x), "homeTeam": side(h, y)} for a, x, h, y in games]}
        for d, games in dates
    ]}


BOARD = [
    ("2024-01-01", [("A", 1, "B", 2), ("C", 3, "D", 0), ("E", None, "F", None), ("G", 4, "H", 1)]),
    ("2024-01-02", [("B", 2, "A", 2), ("D", 5, "C", None)]),
    ("2024-01-03", []),
    ("2024-01-04", [("H", None, "G", None), ("A", 1, "C", 1)]),
    ("2024-01-05", [("F", 0, "E", 1)]),
]


def test_scoreboard_take_while_marks_and_digest(spark):
    text = json.dumps(_board(BOARD))
    docs = spark.createDataFrame([(1, text)], "board long, json string")
    good, _ = S.split_malformed(S.parse_payloads(docs, "json", SCOREBOARD_PAYLOAD))
    rows = S.flatten_scoreboard(good, "board").orderBy("date_pos", "game_pos").collect()
    assert [(r.date_play, r.away_teams, r.away_result, r.home_result) for r in rows] == [
        ("2024-01-01", "A", 1, 2), ("2024-01-01", "C", 3, 0),
        ("2024-01-02", "B", 2, 2), ("2024-01-02", "D", 5, None),
        ("2024-01-05", "F", 0, 1),
    ]
    assert [r.new_date for r in rows] == [False, False, True, False, True]
    from rinkstat.plans.digest import digest_lines
    text = "".join(r.line for r in digest_lines(
        S.flatten_scoreboard(good, "board"), "board").orderBy("date_pos", "game_pos").collect())
    assert text == (
        "2024-01-01 A 1:2 B.\n2024-01-01 C 3:0 D.\n"
        "\n2024-01-02 B 2:2 A.\n2024-01-02 D 5:- C.\n"
        "\n2024-01-05 F 0:1 E.\n"
    )
    all_rows = S.flatten_scoreboard(good, "board", take_while=False).count()
    assert all_rows == 9


def test_empty_scoreboard_gives_no_rows(spark):
    docs = spark.createDataFrame([(1, '{"gamesByDate": []}'), (2, "{}")], "board long, json string")
    good, bad = S.split_malformed(S.parse_payloads(docs, "json", SCOREBOARD_PAYLOAD))
    assert S.flatten_scoreboard(good, "board").count() == 0 and bad.count() == 0


def _python_take_while(board):
    out = []
    for d, games in board:
        for a, x, h, y in games:
            if x is None:
                break
            out.append((d, a, x, y, h))
    return out


def test_take_while_property(spark):
    rnd = random.Random(3)
    boards = []
    for b in range(40):
        dates = []
        for d in range(rnd.randrange(0, 6)):
            games = [(f"A{g}", rnd.choice([None, 1, 2, 3]), f"H{g}", rnd.choice([None, 0, 1]))
                     for g in range(rnd.randrange(0, 6))]
            dates.append((f"2024-02-{d + 1:02d}", games))
        boards.append((b, dates))
    docs = spark.createDataFrame([(b, json.dumps(_board(d))) for b, d in boards], "board long, json string")
    good, _ = S.split_malformed(S.parse_payloads(docs, "json", SCOREBOARD_PAYLOAD))
    got = {}
    for r in S.flatten_scoreboard(good, "board").orderBy("board", "date_pos", "game_pos").collect():
        got.setdefault(r.board, []).append((r.date_play, r.away_teams, r.away_result, r.home_result, r.home_teams))
    for b, dates in boards:
        assert got.get(b, []) == _python_take_while(dates)


def test_flat_take_while_and_change_marks_match_in_document_form(spark):
    from rinkstat.operators.ordered import change_marks, take_while
    text = json.dumps(_board(BOARD))
    docs = spark.createDataFrame([(1, text), (2, text)], "board long, json string")
    good, _ = S.split_malformed(S.parse_payloads(docs, "json", SCOREBOARD_PAYLOAD))
    flat = S.flatten_scoreboard(good, "board", take_while=False).drop("new_date")
    kept = take_while(flat, ["board", "date_pos"], "game_pos", F.col("away_result").isNotNull())
    marked = change_marks(kept, ["board"], ["date_pos"], ["game_pos"], "new_date")
    in_doc = S.flatten_scoreboard(good, "board")
    cols = sorted(in_doc.columns)
    assert sorted(map(tuple, marked.select(*cols).collect())) == sorted(map(tuple, in_doc.select(*cols).collect()))
    glob = change_marks(kept.filter("board = 1"), [], ["date_pos"], ["game_pos"], "m")
    assert [r.m for r in glob.orderBy("date_pos", "game_pos").collect()] == [False, False, True, False, True]
