"""Bucketed history: anti-join and merge without shuffling it."""

import os
import uuid

import pytest

from rinkstat.operators.merge import upsert
from rinkstat.sinks import bucketed as B

KEYS = ["p", "g"]


@pytest.fixture
def big_sides(spark):
    """Joins as for sides too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _history(spark, tmp_path, rows):
    name = f"h_{uuid.uuid4().hex}"
    df = spark.createDataFrame(rows, "p int, g int, v string")
    B.write_bucketed(df, name, str(tmp_path / name), KEYS, 4)
    return name, df


OLD = [(p, g, "old") for p in range(20) for g in range(5)] + [(3, 3, "old twice"), (None, 1, "no key")]
NEW = [(p, g, "new") for p in range(10, 30) for g in range(3)] + [(None, 1, "no key either")]


def test_anti_join_does_not_shuffle_the_history(spark, tmp_path, big_sides):
    name, old = _history(spark, tmp_path, OLD)
    new = spark.createDataFrame(NEW, old.schema)
    kept = B.anti_join_bucketed(name, new, KEYS)
    plan = _plan(kept)
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan
    history = plan.index("FileScan parquet")
    assert plan.rfind("Exchange", 0, history) == -1  # the one exchange is the other side's
    assert sorted(map(str, kept.collect())) == sorted(map(str, old.join(new, KEYS, "left_anti").collect()))


def test_merge_plan_has_no_exchange_at_all(spark, tmp_path):
    name, old = _history(spark, tmp_path, OLD)
    new = spark.createDataFrame(NEW, old.schema)
    plan = _plan(B._merged(B.landed_beside(new, name, KEYS), spark.table(name), KEYS))
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_merge_equals_upsert_and_keeps_the_buckets(spark, tmp_path):
    name, old = _history(spark, tmp_path, OLD)
    new = spark.createDataFrame(NEW, old.schema)
    expected = sorted(map(str, upsert(new, old, KEYS).collect()))
    for again in range(3):
        into = f"h_{uuid.uuid4().hex}"
        merged = B.merge_bucketed(new, name, into, str(tmp_path / into), KEYS)
        assert B.bucket_count(spark, into) == 4
        assert len([f for f in os.listdir(tmp_path / into) if f.endswith(".parquet")]) <= 8
        if not again:
            assert sorted(map(str, merged.collect())) == expected
        name = into
    # Rows with a NULL key match none and come again with every merge, as in ``upsert``.
    keyed = [r for r in map(str, merged.collect()) if "p=None" not in r]
    assert sorted(keyed) == [r for r in expected if "p=None" not in r]


def test_empty_sides_and_wrong_table(spark, tmp_path):
    name, old = _history(spark, tmp_path, OLD)
    none = spark.createDataFrame([], old.schema)
    assert B.anti_join_bucketed(name, none, KEYS).count() == len(OLD)
    empty, _ = _history(spark, tmp_path, [])
    merged = B.merge_bucketed(old, empty, f"h_{uuid.uuid4().hex}", str(tmp_path / "m"), KEYS)
    assert merged.count() == len(OLD)
    plain = f"t_{uuid.uuid4().hex}"
    old.write.option("path", str(tmp_path / plain)).saveAsTable(plain)
    with pytest.raises(ValueError, match="not bucketed"):
        B.bucket_count(spark, plain)


def test_buckets_follow_the_rows(spark):
    assert B.buckets_for(spark.range(1000), 4, 100) == 10 and B.buckets_for(spark.range(1001), 4, 100) == 11
    assert B.buckets_for(spark.range(50), 4, 100) == 4 and B.buckets_for(spark.range(0), 4, 100) == 4
