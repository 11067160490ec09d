import random
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rinkstat.llm import near_dup, queries, stages

from .data import documents, frame, words


def shingles(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, threshold=85):
    sets = {d: shingles(t) for d, t, *_ in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    holders = {}
    for d in ids:
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    pairs = {(a, b) for v in holders.values() for i, a in enumerate(v) for b in v[i + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def chains(seed=1, n=40):
    """Groups of copies of copies, each with some words changed, and copies of different case."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(6):
        text = [rng.choice(vocab) for _ in range(rng.randrange(60, 300))]
        for _ in range(n):
            rows.append((k * 7 % 1009, " ".join(text), None, None, 0))
            k += 1
            if rng.random() < 0.7:
                for _ in range(rng.randrange(1, 4)):
                    text[rng.randrange(len(text))] = rng.choice(vocab)
            if rng.random() < 0.1:
                text = [t.upper() for t in text]
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize(("threshold", "pivots", "block"), [(85, (2, 8), 512), (85, (), 4), (80, (1,), 7)])
def test_components_equal_brute_force(spark, threshold, pivots, block):
    rows = chains() + [(d + 5000, t, *r) for d, t, *r in documents()]
    df = frame(spark, rows).withColumn("component_id", F.lit("clash"))
    assert result(near_dup.near_duplicates(df, threshold, pivots=pivots, block=block)) == brute(rows, threshold)


def test_ids_nulls_and_empty_table(spark):
    rows = [(5, "a b c d e f", None, None, 0), (5, "a b c d e f", None, None, 0), (3, "A B c D e F", None, None, 0), (None, "a b c d e f", None, None, 0), (4, None, None, None, 0)]
    got = sorted((tuple(r) for r in near_dup.near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == [(3, 2, 3, True), (4, 0, 4, True), (5, 2, 3, False), (5, 2, 3, False), (None, 2, None, True)]
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    texts = [(5, a), (5, b), (5, b), (3, b + " more"), (7, a + " more"), (7, "x y z"), (8, "B" + b[1:]), (9, a), (9, "")]
    docs = frame(spark, [(d, t, None, None, len(t)) for d, t in texts])
    got = sorted(tuple(r) for r in near_dup.near_duplicates(docs).select("doc_id", "component_id", "kept", "n_shingles").collect())
    assert got == sorted([
        (5, 5, True, 56), (5, 3, False, 56), (5, 3, False, 56), (3, 3, True, 57), (7, 5, False, 57), (7, 7, True, 1),
        (8, 3, False, 56), (9, 5, False, 56), (9, 9, True, 0),
    ])
    left = sorted((r.doc_id, r.text) for r in stages.near_duplicates(spark, docs, "").collect())
    assert left == sorted([(5, a), (3, b + " more"), (7, "x y z"), (9, "")])


def test_no_two_classes_share_a_name(spark):
    few = lambda *c: F.pmod(F.xxhash64(*c), F.lit(400))  # noqa: E731  60 digests in 400 names collide
    classes = spark.range(60).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("digest"), F.col("id").alias("first_id"))
    assert classes.select(few("digest").alias("rep")).distinct().count() < 60
    got = near_dup.uniquely_named(classes, few).collect()
    assert len({r.rep for r in got}) == 60 and {r.first_id for r in got} == set(range(60))
    assert near_dup.uniquely_named(classes.limit(0)).count() == 0


def test_pairs_at_the_threshold_are_met():
    """Recall as measured: pairs of sets at exactly 80 and 85 percent share a key and stay under the long distance."""
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        m = near_dup.chunks_for(percent / 100)
        factors = np.random.default_rng(11).integers(0, 1 << 31, m * near_dup.CHUNK, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        seeds = np.random.default_rng(13).integers(0, 1 << 32, near_dup.BITS, dtype=np.uint32)
        kept, most = np.array(near_dup.kept_places(m)), near_dup.bits_for(percent / 100)
        for trial in range(600):
            both, alone = percent * (1 + trial % 4), (100 - percent) * (1 + trial % 4)
            pool = np.unique(rng.integers(0, 1 << 63, both + alone).astype(np.uint64) * np.uint64(2))
            rng.shuffle(pool)
            own = int(rng.integers(0, alone + 1))
            a, b = pool[: both + own], np.concatenate([pool[:both], pool[both + own :]])
            agree = near_dup.sign(a, factors) == near_dup.sign(b, factors)
            assert agree[kept].all(axis=1).any(), (percent, trial)
            x, y = (np.frombuffer(near_dup.long_signature(s, seeds), np.uint8) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= most, (percent, trial)


def test_groups_are_streamed_whole():
    sizes = [1, 1, 7, 3, 30, 10, 10, 2, 1, 25]
    flat = [g for g, n in enumerate(sizes) for _ in range(n)]
    read = 0

    def batches():
        nonlocal read
        for i in range(0, len(flat), 10):
            part = flat[i : i + 10]
            read += len(part)
            yield pa.RecordBatch.from_pydict({"_group": pa.array(part, pa.int64()), "at": list(range(i, i + len(part)))})
            yield pa.RecordBatch.from_pydict({"_group": pa.array([], pa.int64()), "at": pa.array([], pa.int64())})

    seen, rows = [], []
    for table in near_dup.whole_groups(batches()):
        assert read - len(rows) <= max(sizes) + 2 * 10
        here = table.column("_group").to_pylist()
        assert not set(here) & set(seen)
        seen += here
        rows += table.column("at").to_pylist()
    assert seen == flat and rows == list(range(len(flat)))


def test_block_groups_reach_tasks_sorted(spark):
    docs = spark.createDataFrame([(i, 0, i, i) for i in range(4)], "key long, n int, rep long, comp long")
    classes = spark.createDataFrame([(i, [1] * 10, bytearray(128)) for i in range(4)], "rep long, signature array<short>, bits binary")
    labels, members = docs.select("rep", "comp"), docs.select(F.lit(1).alias("key"), "n", "rep")
    pairs = near_dup.block_pairs(members, labels, classes, [(0, 1, 2, 3)], 10, 2)
    assert {(r.a, r.b) for r in pairs.collect()} == {(a, b) for a in range(4) for b in range(a + 1, 4)}
    assert "sort [_group" in pairs._jdf.queryExecution().optimizedPlan().toString().lower()


def test_chunks_keep_the_promise():
    for threshold in (0.8, 0.85, 0.95):
        m = near_dup.chunks_for(threshold)
        k, most = m * near_dup.CHUNK, 2 * m - 1
        assert sum(comb(k, i) * (1 - threshold) ** i * threshold ** (k - i) for i in range(most + 1, k + 1)) < 1e-6
        n, p, d = near_dup.BITS, (1 - threshold) / 2, near_dup.bits_for(threshold)
        assert n * p < d < n * p + 6 * (n * p * (1 - p)) ** 0.5


def test_every_pair_under_the_distance_shares_a_key(spark):
    rng = np.random.default_rng(0)
    m = 4
    base = rng.integers(-30000, 30000, m * near_dup.CHUNK)
    rows = [(0, [int(x) for x in base])]
    for i in range(1, 200):
        v = base.copy()
        at = rng.choice(len(v), 2 * m - 1, replace=False)
        v[at] = rng.integers(-30000, 30000, len(at))
        rows.append((i, [int(x) for x in v]))
    keys = near_dup.keyed(spark.createDataFrame(rows, "rep long, signature array<short>"), near_dup.kept_places(m))
    own = {r.key for r in keys.filter("rep = 0").collect()}
    assert {r.rep for r in keys.collect() if r.key in own} == set(range(200))


def test_signatures_estimate_similarity():
    factors = np.random.default_rng(11).integers(0, 1 << 31, 2000, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    pool = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2))
    a, b = pool[:2000], pool[500:2500]
    assert abs((near_dup.sign(a, factors) == near_dup.sign(b, factors)).mean() - 1500 / 2500) < 0.04


def test_long_signatures_estimate_similarity():
    seeds = np.random.default_rng(13).integers(0, 1 << 32, near_dup.BITS, dtype=np.uint32)
    rng, off = np.random.default_rng(5), []
    for n in (40, 150, 1500):
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, n * 2).astype(np.uint64) * np.uint64(2)
            cut = max(1, n // 12)
            a, b = pool[:n], pool[cut : n + cut]
            x, y = (np.frombuffer(near_dup.long_signature(s, seeds), np.uint8) for s in (a, b))
            want = near_dup.BITS * (1 - (n - cut) / (n + cut)) / 2
            off.append((np.bitwise_count(x ^ y).sum() - want) / (want * (1 - want / near_dup.BITS)) ** 0.5)
    assert abs(np.mean(off)) < 0.4 and np.std(off) < 1.4 and np.abs(off).max() < 4.5


def test_connect_long_chain(spark):
    n = 300
    rng = random.Random(4)
    order = list(range(n))
    rng.shuffle(order)
    labels = spark.createDataFrame([(i, i) for i in range(n + 2)], "rep long, comp long")
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a long, b long")
    assert {(r.rep, r.comp) for r in near_dup.connect(labels, links).collect()} == {(i, 0) for i in range(n)} | {(n, n), (n + 1, n + 1)}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = result(queries.QUERIES["op8_multi_index_near_dup"](spark, sf))
    want = brute(rows)
    assert got == want
    assert sum(not k for *_, k in want.values()) > 50
