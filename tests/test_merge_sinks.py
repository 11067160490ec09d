import os
import random

from pyspark.sql import functions as F

from rinkstat.operators.merge import dedupe_latest, split_null_keys, union_by_name, upsert
from rinkstat.sinks import parquet as K

SCHEMA = "playerId bigint, name string, team string, updatedDt string"


def _df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_upsert_day1_day2_rerun(spark):
    day1 = _df(spark, [(1, "a", "X", "d1"), (2, "b", "X", "d1"), (3, "c", "Y", "d1")])
    day2 = _df(spark, [(2, "b", "Z", "d2"), (4, "d", "Y", "d2")])
    merged = upsert(day2, day1, "playerId")
    again = upsert(day2, merged, "playerId")
    exp = [(1, "a", "X", "d1"), (2, "b", "Z", "d2"), (3, "c", "Y", "d1"), (4, "d", "Y", "d2")]
    assert sorted(map(tuple, merged.collect())) == exp
    assert sorted(map(tuple, again.collect())) == exp


def test_upsert_matches_columns_by_name(spark):
    old = _df(spark, [(1, "a", "X", "d1")])
    new = _df(spark, [("Y", "d2", 2, "b")], "team string, updatedDt string, playerId bigint, name string")
    got = sorted(tuple(r) for r in upsert(new, old, "playerId").select("playerId", "name", "team", "updatedDt").collect())
    assert got == [(1, "a", "X", "d1"), (2, "b", "Y", "d2")]


def test_first_load_and_composite_keys(spark):
    new = _df(spark, [(1, 10, 5), (1, 11, 6)], "playerId bigint, gameId bigint, goals int")
    assert upsert(new, None, ["playerId", "gameId"]).count() == 2
    old = _df(spark, [(1, 10, 1), (2, 10, 2)], "playerId bigint, gameId bigint, goals int")
    got = sorted(map(tuple, upsert(new, old, ["playerId", "gameId"]).collect()))
    assert got == [(1, 10, 5), (1, 11, 6), (2, 10, 2)]


def test_dedupe_and_null_keys(spark):
    new = _df(spark, [(1, "a", "X", "d1"), (1, "a", "Y", "d2"), (None, "z", "Q", "d2")])
    good, bad = split_null_keys(new, "playerId")
    assert bad.count() == 1
    got = [tuple(r) for r in dedupe_latest(good, "playerId", "updatedDt").collect()]
    assert got == [(1, "a", "Y", "d2")]


def test_union_by_name_fills_gaps_with_null(spark):
    a = _df(spark, [(1, 5)], "playerId bigint, goals int")
    b = _df(spark, [(2, 30)], "playerId bigint, shotsAgainst int")
    got = sorted(tuple(r) for r in union_by_name(a, b).collect())
    assert got == [(1, 5, None), (2, None, 30)]


def test_upsert_properties(spark):
    rnd = random.Random(11)
    for _ in range(5):
        old_keys = rnd.sample(range(60), 25)
        new_keys = rnd.sample(range(60), 20)
        old = _df(spark, [(k, f"o{k}", "T", "d1") for k in old_keys])
        new = _df(spark, [(k, f"n{k}", "T", "d2") for k in new_keys])
        once = upsert(new, old, "playerId")
        twice = upsert(new, once, "playerId")
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
        assert once.select("playerId").distinct().count() == len(set(old_keys) | set(new_keys))
        assert once.filter(F.col("updatedDt") == "d2").count() == len(new_keys)


def test_snapshot_self_merge_keeps_history_with_aqe_off(spark, tmp_path):
    path = str(tmp_path / "dwh" / "players_info")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        K.upsert_table(spark, _df(spark, [(1, "a", "X", "d1"), (2, "b", "X", "d1")]), path, "playerId")
        K.upsert_table(spark, _df(spark, [(2, "b", "Z", "d2"), (3, "c", "Y", "d2")]), path, "playerId")
        out = K.upsert_table(spark, _df(spark, [(2, "b", "Z", "d2"), (3, "c", "Y", "d2")]), path, "playerId")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert sorted(map(tuple, out.select("playerId", "name", "team", "updatedDt").collect())) == [
        (1, "a", "X", "d1"), (2, "b", "Z", "d2"), (3, "c", "Y", "d2")
    ]
    leftovers = [n for n in os.listdir(tmp_path / "dwh") if n != "players_info"]
    assert leftovers == []


def test_snapshot_num_files_and_sorted_layout(spark, tmp_path):
    df = spark.range(0, 1000).select(F.col("id").alias("playerId"), (F.col("id") % 7).alias("g"))
    path = str(tmp_path / "agg")
    K.write_snapshot(df, path, num_files=3, sort_by=["playerId"])
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(files) == 3
    firsts = [spark.read.parquet(os.path.join(path, f)).agg(F.min("playerId")).first()[0] for f in files]
    assert firsts == sorted(firsts)
    back = spark.read.parquet(path)
    assert back.count() == 1000


def test_dated_partition_rerun_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "raw" / "games_info")
    K.write_dated_partition(_df(spark, [(1, "a", "X", "d1")]), root, "2024-01-01")
    K.write_dated_partition(_df(spark, [(2, "b", "X", "d2")]), root, "2024-01-02")
    K.write_dated_partition(_df(spark, [(3, "c", "X", "d1")]), root, "2024-01-01")
    back = K.read_dated_partition(spark, root)
    got = sorted((r.playerId, str(r.ds)) for r in back.collect())
    assert got == [(2, "2024-01-02"), (3, "2024-01-01")]
    one = K.read_dated_partition(spark, root, "2024-01-02")
    assert [r.playerId for r in one.collect()] == [2]


def test_write_text_sorted(spark, tmp_path):
    lines = spark.createDataFrame([(1, 2, "b\n"), (1, 1, "a\n"), (2, 0, "\nc\n")], "d int, g int, line string")
    path = str(tmp_path / "digest")
    K.write_text_sorted(lines, path, ["d", "g"])
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    text = "".join(open(os.path.join(path, f)).read() for f in parts)
    assert text == "a\nb\n\nc\n"


def test_interrupted_swap_is_recovered(spark, tmp_path):
    path = str(tmp_path / "dwh" / "teams")
    K.write_snapshot(_df(spark, [(1, "a", "X", "d1")]), path)
    os.rename(path, path + ".__retired-deadbeef")  # driver died between the renames
    out = K.upsert_table(spark, _df(spark, [(2, "b", "Y", "d2")]), path, "playerId")
    assert sorted(r.playerId for r in out.collect()) == [1, 2]


def test_partition_scoped_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "dwh" / "games_info")
    schema = "playerId bigint, gameId bigint, goals int, season int"
    day1 = spark.createDataFrame(
        [(1, 100, 1, 2023), (2, 100, 0, 2023), (1, 200, 2, 2024), (3, 201, 1, 2024)], schema
    )
    K.upsert_partitioned(spark, day1, path, ["playerId", "gameId"], "season")
    untouched = sorted(os.listdir(os.path.join(path, "season=2023")))
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cols = ["playerId", "gameId", "goals", "season"]
        day2 = spark.createDataFrame([(1, 200, 5, 2024), (4, 202, 0, 2024)], schema)
        out = sorted(map(tuple, K.upsert_partitioned(spark, day2, path, ["playerId", "gameId"], "season")
                         .select(*cols).collect()))
        again = sorted(map(tuple, K.upsert_partitioned(spark, day2, path, ["playerId", "gameId"], "season")
                           .select(*cols).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    exp = [(1, 100, 1, 2023), (1, 200, 5, 2024), (2, 100, 0, 2023), (3, 201, 1, 2024), (4, 202, 0, 2024)]
    assert out == exp and again == exp
    assert sorted(os.listdir(os.path.join(path, "season=2023"))) == untouched
    assert [n for n in os.listdir(path) if "__" in n] == []
    assert [n for n in os.listdir(tmp_path / "dwh") if n != "games_info"] == []


def test_partition_scoped_upsert_prunes_the_old_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000).selectExpr("id % 10 AS playerId", "id AS gameId", "CAST(id DIV 100 AS INT) AS season") \
        .write.partitionBy("season").parquet(path)
    new = spark.createDataFrame([(1, 5, 0)], "playerId bigint, gameId bigint, season int")
    captured = []
    orig = K.upsert

    def spy(n, o, keys, dedupe_by=None):
        captured.append(o)
        return orig(n, o, keys, dedupe_by)

    K.upsert = spy
    try:
        K.upsert_partitioned(spark, new, path, ["playerId", "gameId"], "season")
    finally:
        K.upsert = orig
    plan = captured[0]._jdf.queryExecution().executedPlan().toString()
    part_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "season" in part_filters and ("= 0)" in part_filters or "IN (0)" in part_filters), part_filters


def test_dead_driver_between_partition_renames_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "dwh" / "games_info")
    schema = "playerId bigint, gameId bigint, goals int, season int"
    day1 = spark.createDataFrame([(1, 100, 1, 2023), (1, 200, 2, 2024), (3, 201, 1, 2024)], schema)
    K.upsert_partitioned(spark, day1, path, ["playerId", "gameId"], "season")
    day2 = spark.createDataFrame([(1, 200, 5, 2024)], schema)
    os.rename(f"{path}/season=2024", f"{path}/.season=2024.__retired-deadbeef")  # moved aside, successor not in yet
    cols = ["playerId", "gameId", "goals", "season"]
    out = K.upsert_partitioned(spark, day2, path, ["playerId", "gameId"], "season")
    want = [(1, 100, 1, 2023), (1, 200, 5, 2024), (3, 201, 1, 2024)]
    assert sorted(map(tuple, out.select(*cols).collect())) == want
    os.makedirs(f"{path}/.season=2024.__retired-old")  # the successor is in, the old one not yet removed
    assert K.table_exists(spark, path)
    assert [n for n in os.listdir(path) if "__retired" in n] == []
    assert sorted(map(tuple, spark.read.parquet(path).select(*cols).collect())) == want


def test_failing_renames_leave_a_repairable_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = "playerId bigint, gameId bigint, goals int, season int"
    K.upsert_partitioned(spark, spark.createDataFrame([(1, 1, 1, 1), (2, 2, 2, 2)], schema), path, ["gameId"], "season")
    new = spark.createDataFrame([(9, 1, 9, 1), (9, 2, 9, 2)], schema)
    real, calls = K._fs, []

    class Dying:
        """A file system whose driver dies at the second rename of a swap."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            calls.append(1)
            if len(calls) == 2:
                raise KeyboardInterrupt
            return self.fs.rename(a, b)

    monkeypatch.setattr(K, "_fs", lambda s, p: (Dying(real(s, p)[0]), real(s, p)[1]))
    try:
        K.upsert_partitioned(spark, new, path, ["gameId"], "season")
    except KeyboardInterrupt:
        pass
    monkeypatch.setattr(K, "_fs", real)
    assert len(calls) == 2
    out = K.upsert_partitioned(spark, spark.createDataFrame([(9, 1, 9, 1)], schema), path, ["gameId"], "season")
    assert sorted((r.gameId, r.goals) for r in out.collect()) == [(1, 9), (2, 2)]


def test_empty_rerun_of_a_date_empties_it(spark, tmp_path):
    root = str(tmp_path / "raw" / "games_info")
    K.write_dated_partition(_df(spark, [(i, "a", "X", "d1") for i in range(5)]), root, "2024-01-01")
    K.write_dated_partition(_df(spark, [(7, "a", "X", "d2")]), root, "2024-01-02")
    K.write_dated_partition(_df(spark, []), root, "2024-01-01")
    assert K.read_dated_partition(spark, root, "2024-01-01").count() == 0
    assert [r.playerId for r in K.read_dated_partition(spark, root).collect()] == [7]


def test_partitions_are_written_in_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "CAST(id % 5 AS INT) AS season")
    K.write_snapshot_partitioned(df, path, "season")
    for p in range(5):
        assert len([f for f in os.listdir(f"{path}/season={p}") if f.endswith(".parquet")]) == 1


def test_dedupe_null_order_and_ties_do_not_depend_on_the_layout(spark):
    rows = [(k, f"n{i}", f"T{(k * 7 + i) % 5}", None if i % 3 else "d1") for k in range(50) for i in range(4)]
    rows += [(100, "only", "T", None), (101, None, None, None)]
    seen = []
    for n in (1, 2, 7):
        df = _df(spark, rows).repartition(n, "team")
        seen.append(sorted(map(str, dedupe_latest(df, "playerId", "updatedDt").collect())))
    assert seen[0] == seen[1] == seen[2]
    got = {r.playerId: r for r in dedupe_latest(_df(spark, rows), "playerId", "updatedDt").collect()}
    assert tuple(got[100]) == (100, "only", "T", None)
    for k in range(50):
        own = [r for r in rows if r[0] == k and r[3] is not None]
        assert tuple(got[k]) == max(own, key=lambda r: (r[3], r[1], r[2]))


def test_dealt_rows_are_written_without_another_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "CAST(id % 5 AS INT) AS season")
    for write in (K.write_snapshot_partitioned, K.replace_partitions):
        write(df, path, "season", gather=False)
        for p in range(5):
            assert len([f for f in os.listdir(f"{path}/season={p}") if f.endswith(".parquet")]) == 4
        assert spark.read.parquet(path).count() == 4000
