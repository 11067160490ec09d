"""Hot-key fixtures: one key holds a third of all rows; results vs brute force."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from rinkstat.operators.merge import upsert
from rinkstat.operators.ordered import first_row_per_group, take_while
from rinkstat.plans.player_stats import player_aggregate
from rinkstat.schemas import GAMES_INFO_TABLE, PLAYERS_INFO_TABLE, TEAMS_TABLE

N = 3000


def _games(rnd):
    rows = []
    for i in range(N):
        pid = 1 if i % 3 == 0 else rnd.randrange(2, 60)  # player 1: a third of all rows
        team = rnd.choice(["ALP", "BET"])
        base = {f.name: None for f in GAMES_INFO_TABLE.fields}
        base.update(playerId=pid, gameId=i, teamAbbrev=team, opponentAbbrev="BET", homeRoadFlag=rnd.choice("HR"),
                    toi=f"{rnd.randrange(0, 30)}:{rnd.randrange(0, 60):02d}", goals=rnd.randrange(0, 3),
                    points=rnd.randrange(0, 4), shots=rnd.randrange(0, 9))
        rows.append(tuple(base[f.name] for f in GAMES_INFO_TABLE.fields))
    return rows


def test_hot_player_aggregate_matches_brute_force(spark):
    import datetime as dt

    rnd = random.Random(5)
    games = _games(rnd)
    players = [(p, f"h{p}", "F", f"L{p % 4}", "C", "L", dt.date(2000, 1, 1), "c", "x", "p", "ALP", "d")
               for p in range(1, 60)]
    teams = [(1, "Alpha", "ALP"), (2, "Beta", "BET")]
    g = spark.createDataFrame(games, GAMES_INFO_TABLE)
    agg = player_aggregate(g, spark.createDataFrame(players, PLAYERS_INFO_TABLE),
                           spark.createDataFrame(teams, TEAMS_TABLE), "skater")
    exp = defaultdict(lambda: [0, 0, 0])
    names = [f.name for f in GAMES_INFO_TABLE.fields]
    for r in games:
        d = dict(zip(names, r))
        m, s = d["toi"].split(":")
        e = exp[(d["playerId"], d["teamAbbrev"], d["homeRoadFlag"])]
        e[0] += 1
        e[1] += d["goals"]
        e[2] += int(m) * 60 + int(s)
    got = {(r.playerId, r.teamAbbrev, r.homeRoadFlag): [r.gamesCNT, r.goals, r.toi] for r in agg.collect()}
    assert got == dict(exp)


def test_hot_key_upsert_and_first_row(spark):
    old = spark.range(0, N).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    new = spark.createDataFrame([(1, -1), (5, -5)], "k bigint, v bigint")
    merged = upsert(new, old, "k")
    ks = [r.k for r in merged.collect()]
    hot_rows = N // 3 + 1  # ids divisible by 3, plus id 1 itself
    assert ks.count(1) == 1 and ks.count(5) == 1 and len(ks) == N - hot_rows - 1 + 2
    first = first_row_per_group(old, ["k"], ["v"]).filter("k = 1").first()
    assert first.v == 0


def test_hot_scope_take_while_matches_python(spark):
    rnd = random.Random(9)
    rows = [(0 if i % 3 == 0 else rnd.randrange(1, 50), i, rnd.random() > 0.02) for i in range(N)]
    df = spark.createDataFrame(rows, "scope int, pos int, ok boolean")
    got = {(r.scope, r.pos) for r in take_while(df, ["scope"], "pos", F.col("ok")).collect()}
    exp, stopped = set(), set()
    for s, p, ok in sorted(rows, key=lambda r: (r[0], r[1])):
        if s in stopped:
            continue
        if not ok:
            stopped.add(s)
            continue
        exp.add((s, p))
    assert got == exp
