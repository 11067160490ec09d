"""Operators over one globally ordered table, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from rinkstat.operators.segments import change_marks_ordered, take_while_ordered

SCHEMA = "at int, block string, ok boolean, _range string"


def kept_by_loop(rows):
    out, current, broken = [], object(), False
    for at, block, ok, extra in sorted(rows, key=lambda r: r[0]):
        if block != current:
            current, broken = block, False
        broken = broken or ok is not True
        if not broken:
            out.append((at, block, ok, extra))
    return out


def marks_by_loop(rows):
    out, last = [], None
    for row in sorted(rows, key=lambda r: r[0]):
        out.append((*row, last is not None and last != row[1:2]))
        last = row[1:2]
    return out


def make(seed, n, run, failing):
    rng = random.Random(seed)
    rows, block = [], "a"
    for at in range(n):
        if rng.random() < 1 / run:
            block = rng.choice(["a", "b", "c", None])
        rows.append((at, block, rng.choice([False, None]) if rng.random() < failing else True, "x"))
    return rows


@pytest.mark.parametrize(("seed", "n", "run", "failing"), [(1, 300, 3, 0.3), (2, 300, 120, 0.01), (3, 300, 10_000, 0.004), (4, 7, 2, 0.3), (5, 300, 40, 0.02)])
def test_equal_to_the_loops(spark, seed, n, run, failing):
    rows = make(seed, n, run, failing)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(random.Random(seed).sample(rows, n), SCHEMA)
        kept = take_while_ordered(df, ["at"], ["block"], F.col("ok"))
        marked = change_marks_ordered(df, ["at"], ["block"], "mark")
        assert sorted(tuple(r) for r in kept.collect()) == kept_by_loop(rows)
        assert sorted((tuple(r) for r in marked.collect()), key=lambda r: r[0]) == marks_by_loop(rows)
        assert kept.columns == df.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_span_ranges(spark):
    """One block over all eight ranges, failing once in the third: nothing after that is kept."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(800).select(F.col("id").alias("at"), F.lit("d").alias("block"), (F.col("id") != 250).alias("ok"))
        kept = take_while_ordered(df, ["at"], ["block"], F.col("ok"))
        assert [r.at for r in kept.orderBy("at").collect()] == list(range(250))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_nulls_and_ties(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert take_while_ordered(empty, ["at"], ["block"], F.col("ok")).count() == 0
    assert change_marks_ordered(empty, ["at"], ["block"]).count() == 0
    df = spark.createDataFrame([(None, None, True, "x"), (None, None, True, "x"), (1, "b", None, "y"), (1, "a", True, "y")], SCHEMA)
    marks = change_marks_ordered(df, ["at"], ["block"], "mark").collect()
    assert sorted((r.block or "", r.mark) for r in marks) == [("", False), ("", False), ("a", True), ("b", True)]
    kept = take_while_ordered(df, ["at"], ["block"], F.col("ok")).collect()
    assert sorted(r.block or "" for r in kept) == ["", "", "a"]


def test_no_window_over_all_rows(spark):
    """The only unpartitioned windows lie above an aggregate to one row per range."""
    df = spark.range(50).select(F.col("id").alias("at"), (F.col("id") % 3).alias("block"), F.lit(True).alias("ok"))
    plan = take_while_ordered(df, ["at"], ["block"], F.col("ok"))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    whole = [i for i, line in enumerate(lines) if "Window" in line and "_range#" in line.split("], [")[1] and "_at" not in line]
    assert whole and all(any("Aggregate [_range" in below for below in lines[i:]) for i in whole)
