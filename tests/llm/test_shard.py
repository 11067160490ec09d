import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rinkstat.llm import queries, shard

from .data import documents, frame


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 99_999])
def test_permutation(n):
    got = shard.permute(np.arange(n), n, 7)
    assert sorted(got) == list(range(n))
    assert (shard.permute(np.arange(n), n, 7) == got).all()


def walk(x, n, seed):
    """The Feistel network over plain integers, one number at a time."""
    side = 1
    while side * side < n:
        side += 1
    while True:
        left, right = divmod(x, side)
        for factor, addend in shard.ROUND_KEYS:
            left, right = right, (left + (right * factor + addend + seed) % (2**31 - 1)) % side
        x = left * side + right
        if x < n:
            return x


@pytest.mark.parametrize(("n", "seed"), [(1, 0), (2, 0), (5, 3), (97, 0), (1000, 11), (10_007, 0)])
def test_equal_to_plain_integers(n, seed):
    assert [int(v) for v in shard.permute(np.arange(n), n, seed)] == [walk(x, n, seed) for x in range(n)]


def test_permutation_shuffles():
    got = shard.permute(np.arange(10_000), 10_000)
    assert abs(np.corrcoef(np.arange(10_000), got)[0, 1]) < 0.05
    assert np.mean(np.diff(got) == 1) < 0.01


def test_shards_are_even_and_gapless(spark):
    rows = [*documents(), (None, None, None, None, None), (5, "twice", None, None, 0), (5, "twice", None, None, 0)]
    docs = frame(spark, rows).withColumn("slot", F.lit("clash"))
    got = shard.feistel_shards(docs, ["doc_id", "text"], shards=8).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by.get(s, [])) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    order = sorted(got, key=lambda r: r.row_number)
    assert [r.row_number for r in order] == list(range(len(rows)))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert keys == sorted(keys)
    places = shard.permute(np.arange(len(rows)), len(rows))
    assert all((r.shard, r.slot) == (places[r.row_number] % 8, places[r.row_number] // 8) for r in got)


def test_many_ranges_number_alike(spark):
    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(90)).alias("a"), "id")
    few, n = shard.numbered(df, ["a", "id"])
    many, _ = shard.numbered(df, ["a", "id"], rows_per_range=40)
    assert n == 1000 and sorted(few.collect()) == sorted(many.collect())


def test_empty_table(spark):
    assert shard.feistel_shards(frame(spark, []), ["doc_id"]).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op6_feistel_shards"](spark, sf).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {
        d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in want.items()
    }
    places = {d: walk(i, len(want), 0) for i, d in enumerate(sorted(want))}
    assert {r.doc_id: (r.shard, r.slot) for r in got} == {d: (p % 8, p // 8) for d, p in places.items()}
