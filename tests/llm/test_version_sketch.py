import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from rinkstat.llm import queries
from rinkstat.llm import version_sketch as V

from .data import documents, frame


def elements(text):
    return set(Counter(re.findall(f"[^\n]{{1,{V.PIECE}}}", text or "")).items())


def alike(a, b):
    a, b = elements(a), elements(b)
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def brute(rows):
    rows = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    out = []
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), alike(text, edited), alike(text, after)))
    return sorted(out, key=repr)


def result(df):
    rows = df.select(
        "doc_id", "n_chars", "edited_sha256", V.likeness(F.col("keys"), F.col("edited_keys"), F.col("edited_first")).alias("a"),
        V.likeness(F.col("keys"), F.col("next_keys"), F.col("next_first")).alias("b"),
    ).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def differing(df):
    """``df (a, b)`` with the sketches ``x``, ``y``, their first tables and the differences ``d``."""
    df = df.withColumns({"x": V.sketch_of(F.col("a")), "y": V.sketch_of(F.col("b"))})
    df = df.withColumn("first", V.first_tables(F.col("x"), F.col("y")))
    return df.withColumn("d", V.differences(F.col("a"), F.col("b"), F.col("first")))


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3]
        assert abs(g[3] - w[3]) < 1e-9 and abs(g[4] - w[4]) < 1e-9, (g, w)


def test_edited_and_next_equal_brute_force(spark):
    rows = [*documents(), (6, "again 6", None, None, 0), (6, "again 6", None, None, 0), (None, "null id\nx", None, None, 0), (None, None, None, None, 0)]
    same(result(V.edited_and_next(frame(spark, rows))), brute(rows))


def test_one_row_nulls_only_and_empty_table(spark):
    for rows in ([(3, "abcd\nefgh", None, None, 0)], [(None, "a\nb\nc\nd", None, None, 0), (None, "zz", None, None, 0)]):
        same(result(V.edited_and_next(frame(spark, rows))), brute(rows))
    assert V.edited_and_next(frame(spark, [])).count() == 0


def test_range_numbers(spark):
    bounds = [2, 5, 9, 14, 15, 30, 31]
    got = spark.range(40).select("id", V._range_of(F.col("id"), bounds).alias("r")).collect()
    assert all(r.r == max(sum(b <= r.id for b in bounds) - 1, 0) for r in got)


def test_differences_are_recovered_at_any_size(spark):
    for n in (0, 1, 5, 40, 700):
        a = "\n".join(f"line {i}" for i in range(n))
        b = "\n".join(f"line {i}" for i in range(0, n, 3)) + "\nmore\nmore"
        df = spark.createDataFrame([(a, b)], "a string, b string").select(V.paragraph_keys(F.col("a")).alias("a"), V.paragraph_keys(F.col("b")).alias("b"))
        r = differing(df).first()
        want = {(k, 1) for k in set(r.a) - set(r.b)} | {(k, -1) for k in set(r.b) - set(r.a)}
        assert len(r.d) == len(want) and {(x.k, x.s) for x in r.d} == want


def test_head_and_body_weigh_the_same(spark):
    rng = random.Random(7)
    piece = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    head, body = piece(512), piece(1536)
    rows = [("head", head + piece(1536)), ("body", piece(512) + body)]
    df = spark.createDataFrame([(n, head + body, t) for n, t in rows], "n string, a string, b string")
    keys = differing(df.select("n", V.paragraph_keys(F.col("a")).alias("a"), V.paragraph_keys(F.col("b")).alias("b")))
    got = {r.n: r.v for r in keys.select("n", V.likeness(F.col("a"), F.col("b"), F.col("first")).alias("v")).collect()}
    # shared: a quarter and three quarters of the text, up to a piece
    assert abs(got["head"] - 0.25) < 0.06 and abs(got["body"] - 0.75) < 0.06, got


def test_small_table_fails_when_overfull(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.xxhash64(i)).alias("a"))
    assert df.select(V.peel(V.cells_of(F.col("a"))).alias("p")).first().p is None
    four = df.select(F.slice("a", 1, 4).alias("a")).select("a", V.peel(V.cells_of(F.col("a"))).alias("p")).first()
    assert four.p is None or {x.k for x in four.p} == set(four.a)


def test_sketches_of_any_two_sizes_meet(spark):
    for n, m in ((0, 3), (5, 40), (300, 7), (300, 290)):
        df = spark.range(1).select(
            F.transform(F.expr(f"sequence(1, {max(n, 1)})"), lambda i: F.xxhash64(i)).alias("a"),
            F.transform(F.expr(f"sequence(5, {m + 4})"), lambda i: F.xxhash64(i)).alias("b"),
        ).withColumn("a", F.slice("a", 1, n))
        r = differing(df).withColumn("one", V.folded(F.col("x"), F.lit(1))).first()
        assert {(e.k, e.s) for e in r.d} == {(k, 1) for k in set(r.a) - set(r.b)} | {(k, -1) for k in set(r.b) - set(r.a)}
        assert len(r.d) == len(set(r.a) ^ set(r.b)) and sum(c.n for c in r.one[0]) == V.PARTS * n
        assert len(r.x) & (len(r.x) - 1) == 0 and n <= V.KEYS * len(r.x) and sum(c.n for t in r.x for c in t) == V.PARTS * n


def test_most_edited_texts_peel_at_the_first_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tried = V.edited_and_next(docs).select(F.monotonically_increasing_id().alias("row"), "edited_first")
    tried = tried.select("row", F.explode("edited_first").alias("t"))
    r = tried.groupBy("row").agg(F.count("t").alias("got"), F.count(F.lit(1)).alias("n"))
    r = r.agg((F.sum("got") / F.sum("n")).alias("tables"), F.avg((F.col("got") == F.col("n")).cast("int")).alias("texts")).first()
    assert r.tables > 0.8 and r.texts > 0.5, r


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op5_invertible_sketch"](spark, sf).collect()
    same(sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=repr), brute(rows))
    texts = {r[0]: r[1] for r in rows}
    prints = {}
    for r in got:
        prints.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert len(set.union(*prints.values())) > 0.95 * len(prints)


def test_main_path_is_native(spark):
    plan = queries.QUERIES["op5_invertible_sketch"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
