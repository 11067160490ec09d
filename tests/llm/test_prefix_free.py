import hashlib
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rinkstat.llm import common, prefix_free
from rinkstat.llm.prefix_free import Parse, sliding_min

from .data import documents, frame


def brute(rows, window=50):
    first = {}
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    for d, b in texts:
        if d is not None:
            for i in range(len(b) - window + 1):
                first[b[i : i + window]] = min(first.get(b[i : i + window], d), d)
    out = []
    for d, b in texts:
        gone = bytearray(len(b) + 1)
        if d is not None:
            for i in range(len(b) - window + 1):
                if first[b[i : i + window]] < d:
                    gone[i : i + window] = b"\1" * window
        spans = [i for i in range(len(b)) if gone[i] and not (i and gone[i - 1])]
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((d, len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repetitive(seed, letters, n=120):
    """Texts of few letters cut from shared passages, with copies, runs of one letter and short texts."""
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [text(rng.randrange(20, 300)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            a = rng.randrange(20)
            parts.append(rng.choice(shared)[a : a + rng.randrange(300)] if rng.random() < 0.6 else text(rng.randrange(80)))
        rows.append((i * 37 % 1013, "".join(parts), None, None, 0))
    rows += [(2000 + i, rows[i][1], None, None, 0) for i in range(0, n, 9)]
    return [*rows, (5002, "a" * 3000, None, None, 0), (5003, "a" * 70, None, None, 0), (3, "a" * 49, None, None, 0), (4, "a" * 51, None, None, 0)]


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("seed", "letters", "trigger"), [(0, "ab é", 16), (1, "abcdefgh", 8), (2, "a", 16), (3, "ab", 1), (4, "xyz", 50)])
def test_equals_brute_force(spark, seed, letters, trigger):
    rows = repetitive(seed, letters)
    df = frame(spark, rows).withColumns({"n_bytes": F.lit("clash"), "entry": F.lit(0)}).repartition(5)
    assert result(prefix_free.dedup_bytes(df, trigger=trigger)) == brute(rows)


def test_slices_of_long_texts(monkeypatch, spark):
    rows = repetitive(5, "abc")
    monkeypatch.setattr(prefix_free, "SLICE", 200)
    monkeypatch.setattr(prefix_free, "SEND_BYTES", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(prefix_free.dedup_bytes(frame(spark, rows).repartition(3))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward_rows(spark):
    last = documents()[-5][1]
    rows = [*documents(), (None, last, None, None, 0), (0, last, None, None, 0), (0, last, None, None, 0)]
    assert result(prefix_free.dedup_bytes(frame(spark, rows))) == brute(rows)
    assert prefix_free.dedup_bytes(frame(spark, [])).count() == 0


def test_parts(spark):
    rows = repetitive(6, "abcd")
    texts = {d: (t or "").encode() for d, t, *_ in rows}
    for r in prefix_free.dedup_bytes(frame(spark, rows)).collect():
        kept, at = b"", 0
        for s in r.spans:
            kept, at = kept + texts[r.doc_id][at : s.begin], s.end
        assert bytes(r.kept) == kept + texts[r.doc_id][at:]
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.spans) == r.n_spans


def test_each_window_in_one_entry():
    """Entries cover every window once; equal strings have equal entries wherever they lie."""
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000, dtype=np.uint8)
    data[3000:4000] = data[500:1500]
    p = Parse(data, np.array([0, 2500, 5000]))
    windows = np.concatenate([np.arange(a, b) for a, b in zip(p.begin, p.end, strict=True)])
    assert windows.tolist() == [*range(0, 2451), *range(2500, 4951)]
    inner = lambda a, b: set(p.entry[(p.begin >= a) & (p.end + 49 <= b)].tolist())
    assert inner(600, 1400) <= set(p.entry[(p.begin >= 3000) & (p.begin < 4000)].tolist())


def test_entries_do_not_depend_on_what_is_parsed_beside():
    """One text has the same entries alone, after others and in a run longer than a slice."""
    rng = np.random.default_rng(2)
    text, beside = (rng.integers(97, 123, n, dtype=np.uint8) for n in (60_000, 300_000))
    alone = Parse(text, np.array([0, len(text)]))
    for n in (100, 5_000, 70_000, 300_000):
        p = Parse(np.concatenate([beside[:n], text]), np.array([0, n, n + len(text)]))
        own = p.doc == 1
        assert p.entry[own].tolist() == alone.entry.tolist() and p.trigger[own].tolist() == alone.trigger.tolist()
        assert (p.begin[own] - n).tolist() == alone.begin.tolist() and (p.end[own] - n).tolist() == alone.end.tolist()


def test_long_texts_and_any_ids(spark):
    """Texts of several slices that share passages across their cuts; ids as far apart as longs can be."""
    rng = random.Random(8)
    text = lambda k: "".join(rng.choice("abcdefghij ") for _ in range(k))
    passages = [text(k) for k in (200_000, 3_000, 120, 49, 50)]
    ids = [2**63 - 1, -(2**63), 0, 7, 300, 70_000, 5 * 10**9, -1]
    rows = [(d, text(rng.randrange(9)) + "".join(p + text(3) for p in rng.sample(passages, 3)) * (1 + i % 2), None, None, 0) for i, d in enumerate(ids)]
    assert result(prefix_free.dedup_bytes(frame(spark, rows).repartition(3))) == brute(rows)


def test_rows_are_sent_in_blocks(monkeypatch, spark):
    """What goes through the shuffles is counted in blocks for each bucket, not in rows for each entry and window."""
    rng = random.Random(9)
    text = lambda k: "".join(rng.choice("abcdefghij ") for _ in range(k))
    shared = [text(45) for _ in range(200)]
    texts = ["".join(rng.choice(shared) + text(3) for _ in range(500)) for _ in range(40)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    sent, neighbours = [], prefix_free.neighbours

    def counted(df, *more):
        sent.append(df.count())
        return neighbours(df, *more)

    monkeypatch.setattr(prefix_free, "neighbours", counted)
    monkeypatch.setattr(prefix_free, "LEAST_BUCKETS", 100, raising=False)
    assert result(prefix_free.dedup_bytes(frame(spark, rows).coalesce(1))) == brute(rows)
    entries = [Parse(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])) for t in texts]
    assert len(sent) == 2 and max(sent) < sum(len(p.entry) for p in entries) / 10


def test_only_what_was_told_is_parsed_again(monkeypatch):
    """The last pass parses no text that was told nothing and looks into open entries only."""

    class Rows:
        def mapInArrow(self, function, schema):
            self.function = function
            return self

    rng = random.Random(10)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(4_000)) for _ in range(3)]
    p = Parse(np.frombuffer(texts[0].encode(), np.uint8), np.array([0, 4_000]))
    number, place, prints = p.windows(np.array([5]))
    table = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([1, 2, 3], pa.int64()), "text": texts,
        "settled": pa.array([p.entry[:2].tobytes(), None, None], pa.binary()),
        "open": pa.array([p.entry[5:7].tobytes(), p.entry[:9].tobytes(), None], pa.binary()),
        "found": pa.array([prints[:1].tobytes(), None, None], pa.binary()),
    })
    parsed, looked = [], []

    class Counted(Parse):
        def __init__(self, data, *more):
            parsed.append(len(data))
            super().__init__(data, *more)

        def windows(self, which):
            looked.append(len(which))
            return super().windows(which)

    monkeypatch.setattr(prefix_free, "Parse", Counted)
    out = pa.Table.from_batches(prefix_free.removed(Rows(), 50, 24, True).function(iter([table]))).to_pylist()
    assert parsed == [4_000] and looked == [2]
    begin, end = int(p.begin[0]), int(p.end[1]) + 49
    spans = [(begin, end), (int(place[0]), int(place[0]) + 50)]
    spans = [(begin, max(e for _, e in spans))] if spans[1][0] <= end else spans
    assert [(r["doc_id"], [(x["begin"], x["end"]) for x in r["spans"]]) for r in out] == [(1, spans), (2, []), (3, [])]
    assert [r["kept"] for r in out[1:]] == [t.encode() for t in texts[1:]]


def test_sliding_min():
    v = np.random.default_rng(0).integers(0, 1000, 200).astype(np.uint64)
    for size in (1, 2, 3, 7, 35, 64):
        assert sliding_min(v, size).tolist() == [min(v[i : i + size]) for i in range(len(v) - size + 1)]


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_shuffles_of_the_lists_are_freed(spark):
    before, setting = shuffle_files(spark), spark.conf.get(common.FREE_SHUFFLES, None)
    df = prefix_free.dedup_bytes(frame(spark, repetitive(7, "abcdef")))  # stores the lists
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(common.FREE_SHUFFLES, None) == setting
    assert result(df) == brute(repetitive(7, "abcdef"))
