"""Layouts that let readers skip: Bloom filters on names, two clustered keys, Bloom filters of known keys."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rinkstat.operators.filters import by_exact_name
from rinkstat.operators.joins import semi_join
from rinkstat.session import cluster_conf
from rinkstat.sinks.layout import interleaved, part_of, quantile_cuts, write_clustered, write_for_lookup
from rinkstat.sinks.parquet import write_snapshot


def _scanned(df) -> int:
    """Rows that the scan of an executed query gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().get("numOutputRows").get().value()


def test_name_lookup_skips_files(spark, tmp_path):
    names = spark.range(0, 8000, numPartitions=8).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("playersFIO"))
    names = names.union(spark.createDataFrame([(-1, None), (-2, "")], "id long, playersFIO string"))
    plain, bloom = str(tmp_path / "plain"), str(tmp_path / "bloom")
    write_snapshot(names, plain, options={"parquet.enable.dictionary#playersFIO": "false"})
    write_for_lookup(names, bloom, ["playersFIO"], 1000)
    sought = names.filter("id = 4321").first()["playersFIO"]
    found = by_exact_name(spark.read.parquet(bloom), sought)
    assert [r.id for r in found.collect()] == [4321]
    assert _scanned(by_exact_name(spark.read.parquet(plain), sought)) >= 7000
    assert _scanned(found) <= 2000
    assert spark.read.parquet(bloom).count() == 8002 and by_exact_name(spark.read.parquet(bloom), "").count() == 0


def _files_spanning(path, column, value) -> tuple[int, int]:
    """How many files may hold the value by their footers, and how many there are."""
    files, hits = glob.glob(f"{path}/*.parquet"), 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hits += any(s.min <= value <= s.max for s in stats)
    return hits, len(files)


@pytest.mark.parametrize("hot", [False, True])
def test_either_key_reads_few_files(spark, tmp_path, hot):
    player = F.pmod(F.xxhash64("id"), F.lit(5000))
    if hot:  # one player holds a third of all rows
        player = F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(player)
    games = spark.range(40_000).select(player.alias("playerId"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000))).alias("gameId"), "id")
    path = str(tmp_path / "games")
    write_clustered(games, path, ["playerId", "gameId"], num_files=64)
    table = spark.read.parquet(path)
    assert table.exceptAll(games).isEmpty() and table.count() == 40_000
    for column, value in (("playerId", 2500), ("gameId", 4000)):
        hits, files = _files_spanning(path, column, value)
        assert files >= 50 and hits <= files // 3, (column, hits, files)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert max(sizes) < 6 * 40_000 / 64


def test_parts_cells_nulls_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(None,), (1,), (5,), (5,), (9,)], "a int")
    assert [r[0] for r in df.select(part_of("a", [1, 5])).collect()] == [0, 0, 1, 1, 2]
    cell = interleaved([F.col("a"), F.col("b")], 3)
    pairs = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int").select("a", "b", cell.alias("z")).collect()
    for r in pairs:
        assert r.z == int("".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}", strict=True)), 2)
    empty = df.limit(0)
    assert quantile_cuts(empty, ["a"]) == {"a": []}
    write_clustered(empty, str(tmp_path / "empty"), ["a"])
    assert spark.read.schema("a int").parquet(str(tmp_path / "empty")).count() == 0


def test_known_keys_become_a_bloom_filter_before_parsing(spark, tmp_path):
    """With the cluster's settings, scaled down to this table, unknown payloads are dropped below the shuffle."""
    docs = spark.range(0, 20_000, numPartitions=4).select(F.col("id").alias("playerId"), F.lit('{"gameLog": []}').alias("json"))
    docs.write.parquet(str(tmp_path / "docs"))
    spark.range(20_000).select(F.col("id").alias("playerId"), (F.col("id") % 50).alias("team")).write.parquet(str(tmp_path / "players"))
    wanted = cluster_conf(10**12, 100)
    small = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": wanted["spark.sql.optimizer.runtime.bloomFilter.enabled"],
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": wanted["spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"],
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        known = spark.read.parquet(str(tmp_path / "players")).filter("team = 7")
        kept = semi_join(spark.read.parquet(str(tmp_path / "docs")), known, "playerId")
        parsed = kept.select("playerId", F.from_json("json", "gameLog array<int>").alias("_"))
        assert parsed.count() == 400
        parsed.collect()
        plan = parsed._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan and plan.index("from_json") < plan.index("might_contain")
    finally:
        for k in small:
            spark.conf.unset(k)
