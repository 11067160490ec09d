import json

from rinkstat.streaming import start_game_log_ingest


def _log(path, games):
    with open(path, "w") as f:
        f.write(games if isinstance(games, str) else json.dumps({"gameLog": games}))


def _g(gid, goals):
    return {"gameId": gid, "teamAbbrev": "ALP", "opponentAbbrev": "BET", "homeRoadFlag": "H",
            "commonName": {"default": "Alpha"}, "toi": "10:00", "goals": goals}


def test_available_now_ingest_is_incremental(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    table, ckpt, rejects = str(tmp_path / "games_info"), str(tmp_path / "ckpt"), str(tmp_path / "rejects")
    _log(landing / "11.json", [_g(1, 1), _g(2, 0)])
    _log(landing / "12.json", '{"gameLog": [')
    q = start_game_log_ingest(spark, str(landing), table, ckpt, rejects)
    q.awaitTermination(120)
    got = sorted((r.playerId, r.gameId, r.goals) for r in spark.read.parquet(table).collect())
    assert got == [(11, 1, 1), (11, 2, 0)]
    assert [r.entity for r in spark.read.parquet(rejects).collect()] == ["12"]
    # next day: a corrected game and a new one arrive; old files are not re-read
    _log(landing / "13.json", [_g(7, 2)])
    _log(landing / "11b.json", "{}")
    q = start_game_log_ingest(spark, str(landing), table, ckpt, rejects)
    q.awaitTermination(120)
    got = sorted((r.playerId, r.gameId, r.goals) for r in spark.read.parquet(table).collect())
    assert got == [(11, 1, 1), (11, 2, 0), (13, 7, 2)]
    assert sorted(r.entity for r in spark.read.parquet(rejects).collect()) == ["11b", "12"]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    """A batch applied twice (its offsets were not committed): same table, same rejects, no keyless rows."""
    import shutil

    landing = tmp_path / "landing"
    landing.mkdir()
    table, ckpt, rejects = str(tmp_path / "games_info"), str(tmp_path / "ckpt"), str(tmp_path / "rejects")
    _log(landing / "11.json", [_g(1, 1), _g(None, 4)])
    _log(landing / "coach.json", [_g(2, 3)])
    _log(landing / "12.json", "{\"error\": \"not found\"}")
    seen = []
    for _ in range(2):
        start_game_log_ingest(spark, str(landing), table, ckpt, rejects).awaitTermination(120)
        seen.append((
            sorted(map(str, spark.read.parquet(table).collect())),
            sorted(str((r.entity, r.epoch)) for r in spark.read.parquet(rejects).collect()),
        ))
        shutil.rmtree(f"{ckpt}/commits")
    assert seen[0] == seen[1]
    assert len(seen[0][0]) == 1 and len(seen[0][1]) == 3


def test_stream_merges_into_partitioned_table(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    table, ckpt = str(tmp_path / "games_info"), str(tmp_path / "ckpt")
    for pid, games in ((11, [_g(1, 1), _g(5, 0)]), (12, [_g(2, 3)]), (13, [_g(6, 1)])):
        _log(landing / f"{pid}.json", games)
    q = start_game_log_ingest(spark, str(landing), table, ckpt, games_partition=("block", "CAST(gameId DIV 4 AS INT)"),
                              max_files_per_trigger=1)
    q.awaitTermination(180)
    got = sorted((r.playerId, r.gameId, r.goals, r.block) for r in spark.read.parquet(table).collect())
    assert got == [(11, 1, 1, 0), (11, 5, 0, 1), (12, 2, 3, 0), (13, 6, 1, 1)]
