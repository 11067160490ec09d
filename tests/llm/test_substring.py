import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rinkstat.llm import queries, substring

from .data import documents, frame, words


def brute(rows, window=13):
    first = {}
    texts = [(d, words(t)) for d, t, *_ in rows]
    for d, w in texts:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in texts:
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < d:
                    gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passages(seed=0, n=150, vocab=30):
    """Documents of few different words with shared passages, copies, shifted and nested repeats."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocab)}"
    shared = [[word() for _ in range(rng.randrange(8, 60))] for _ in range(8)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(0, 6)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            text += part[a : a + rng.randrange(1, 60)] if rng.random() < 0.6 else [word() for _ in range(rng.randrange(1, 30))]
        rows.append(((i * 37) % 1013, " ".join(text), None, None, 0))
    rows += [(2000 + i, rows[i][1], None, None, 0) for i in range(0, n, 9)]
    rows += [(3000, "same " * 500, None, None, 0), (3001, "same " * 20, None, None, 0), (1, "same " * 13, None, None, 0)]
    return rows


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("seed", "k", "vocab"), [(0, 4, 30), (1, 7, 3), (2, 1, 500), (3, 13, 30), (4, 4, 2)])
def test_equals_brute_force(spark, seed, k, vocab):
    rows = passages(seed, vocab=vocab)
    df = frame(spark, rows).withColumn("n_words", F.lit("clash")).repartition(5)
    assert result(substring.dedup_substrings(df, seed=k)) == brute(rows)


def test_small_batches_and_chunks(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        rows = passages(7)
        assert result(substring.dedup_substrings(frame(spark, rows).repartition(3))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward_rows(spark):
    rows = [*documents(), (None, documents()[-5][1], None, None, 0), (0, documents()[-5][1], None, None, 0), (0, documents()[-5][1], None, None, 0)]
    assert result(substring.dedup_substrings(frame(spark, rows))) == brute(rows)
    assert substring.dedup_substrings(frame(spark, [])).count() == 0


def test_kept_text(spark):
    for r in substring.dedup_substrings(frame(spark, passages(5))).collect():
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
        assert len(r.kept_text.split()) == r.n_words - r.n_removed


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = result(queries.QUERIES["op4_seed_and_extend"](spark, sf))
    assert got == brute(rows)
    assert sum(r[2] > 0 for r in got) > 50
