"""Plan-shape guards for the scale properties the design relies on."""

import json

from pyspark.sql import functions as F

from rinkstat.operators.aggregates import skater_aggregate
from rinkstat.operators.ordered import change_marks, first_row_per_group
from rinkstat.plans import catalog as CAT
from rinkstat.schemas import SCOREBOARD_PAYLOAD
from rinkstat.sources import payloads as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_payload_is_parsed_once(spark):
    docs = spark.createDataFrame([(1, json.dumps({"gamesByDate": []}))], "board long, json string")
    good, _ = S.split_malformed(S.parse_payloads(docs, "json", SCOREBOARD_PAYLOAD))
    rows = S.flatten_scoreboard(good, "board")
    assert _optimized(rows).count("from_json(") == 1


def test_take_while_needs_no_shuffle_or_window(spark):
    docs = spark.createDataFrame([(1, "{}")], "board long, json string")
    good, _ = S.split_malformed(S.parse_payloads(docs, "json", SCOREBOARD_PAYLOAD))
    plan = _plan(S.flatten_scoreboard(good, "board"))
    assert "Exchange" not in plan and "Window" not in plan


def test_ordered_operators_use_no_window(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g"), (F.col("id") % 5).alias("b"), "id")
    assert "Window" not in _plan(first_row_per_group(df, ["g"], ["id"]))
    assert "Window" not in _plan(change_marks(df, ["g"], ["b"], ["id"]))
    assert "Window" not in _plan(change_marks(df, [], ["b"], ["id"]))


def test_aggregates_combine_map_side(spark):
    mart = CAT._mart(spark, SF)
    plan = _plan(skater_aggregate(mart))
    assert "partial_count" in plan and "partial_sum" in plan
    card = _plan(CAT.q_player_card_skater(spark, SF))
    assert "partial_min" in card and "Window" not in card


def test_no_python_in_registered_queries(spark):
    for name, q in CAT.QUERIES.items():
        if name.startswith("write_"):
            continue
        plan = _plan(q(spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_projection_reaches_the_scan(spark):
    plan = _plan(CAT.q_scan_parquet_filtered(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    assert "GreaterThanOrEqual(l_quantity,10.0)" in plan


def test_cluster_conf_scales_with_input():
    from rinkstat.session import cluster_conf

    big = cluster_conf(100 * 1024**4, total_cores=8000)
    small = cluster_conf(10 * 1024**3, total_cores=64)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (512 * 1024**2)
    assert int(cluster_conf(10**15, 8000, bytes_per_partition=10**9)["spark.sql.shuffle.partitions"]) == 10**6
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_no_plan_deals_rows_round_robin(spark):
    for name, q in CAT.QUERIES.items():
        assert "RoundRobinPartitioning" not in _plan(q(spark, SF)), name


OVER_PLAYERS = ("rollup_home_road", "first_row_per_name", "sort_by_key", "goalie_percentage", "avg_toi")


def test_hot_player_is_reduced_before_the_player_join(spark):
    """With no broadcast the player join is a sort-merge join whose partitioning the aggregate reuses, so AQE
    can't split it: only partial sums may reach it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in OVER_PLAYERS:
            plan = _plan(CAT.QUERIES[name](spark, SF))
            join = plan.index("SortMergeJoin [playerId")
            assert join < plan.index("partial_sum", join) < plan.index("lineitem.parquet", join), name
        stored = _plan(CAT.QUERIES["skater_aggregate_over_mart"](spark, SF))
        assert "Join" not in stored and "partial_sum" in stored
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_date_marks_read_the_stored_table(spark):
    plan = _optimized(CAT.q_date_change_marks(spark, SF))
    assert "from_json" not in plan and "orders.parquet" not in plan


def test_lookup_filter_reaches_the_stored_aggregate(spark):
    for kind in ("skater", "goalie"):
        plan = _plan(CAT.QUERIES[f"player_card_lookup_{kind}"](spark, SF))
        assert f"EqualTo(playersFIO,{CAT.LOOKUP_NAME})" in plan and f"EqualTo(playersFIO,{CAT.UNKNOWN_NAME})" in plan


def test_lookup_from_base_tables_reads_that_players_games(spark):
    from rinkstat.plans.player_stats import card_aggregate

    base = CAT._base(spark, SF)
    plan = _plan(card_aggregate(*base, "skater", name=CAT.LOOKUP_NAME))
    semi = plan.index("LeftSemi")
    assert plan.index("partial_sum") < semi < plan.index("lineitem.parquet")
    got = card_aggregate(*base, "skater", name=CAT.LOOKUP_NAME)
    want = card_aggregate(*base, "skater").filter(F.col("playersFIO") == CAT.LOOKUP_NAME)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_checkpoint_folder_is_not_local_on_a_cluster():
    import pytest

    from rinkstat import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session())
