from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rinkstat.llm import decision_rules as R
from rinkstat.llm import site_quality as S

from .data import documents, frame, words


def brute(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_statistics_equal_brute_force(spark):
    rows = [*documents(), (900, "a b c d e a b c d e f\n\nq\nq\n q\n", None, None, 0), (None, "x\r\nx\r\ny", None, None, 0)]
    docs = frame(spark, rows).withColumn("n_words", F.lit("clash"))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in R.with_statistics(docs).collect()}
    assert got == {r[0]: brute(r[1]) for r in rows}


def test_statistics_of_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in R.with_statistics(docs).collect()}
    assert got == want


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(0)
    x = {f: rng.random(3000) for f in R.FEATURES}
    bad = (x["symbols_per_word"] > 0.8) | ((x["upper_share"] > 0.7) & (x["marks_per_word"] <= 0.3))
    rules = R.learn_rules(x, bad)
    got = np.any([r.holds(x) for r in rules], axis=0)
    assert (got == bad).mean() > 0.98
    assert all(r.terms for r in rules)
    assert R.learn_rules(x, bad) == rules


def test_spark_expression_equals_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = R.fit_rules(docs, labels)
    assert rules
    judged = R.quality_rules(docs, labels, drop_text=True).select("*", *[F.expr(e).alias(f) for f, e in R.FEATURES.items()]).toPandas()
    x = {f: judged[f].to_numpy(float) for f in R.FEATURES}
    hit = np.any([r.holds(x) for r in rules], axis=0) | judged["base_failed"].to_numpy()
    assert (judged["kept"].to_numpy() == ~hit).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, rest = labels.filter("doc_id % 5 <> 0"), labels.filter("doc_id % 5 = 0")
    judged = R.quality_rules(docs, train, drop_text=True).join(rest, "doc_id").filter("NOT base_failed").toPandas()
    good, kept = judged["quality"] == 1, judged["kept"]
    assert kept[good].mean() > 0.98
    assert kept[~good].mean() < 0.1


def test_empty_tables_and_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert R.quality_rules(frame(spark, []), labels).count() == 0
    got = R.quality_rules(frame(spark), labels).collect()
    assert all(r.kept == (not r.base_failed) for r in got)
    nulls = spark.createDataFrame([(None, 0, 0), (3, None, 0), (6, 0, None), (6, 0, None)], "doc_id long, quality int, toxic int")
    assert R.quality_rules(frame(spark), nulls).count() == len(documents())


def test_copies_of_a_labelled_document_train_once(spark, monkeypatch):
    rows = documents()
    labels = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(rows)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(R, "learn_rules", lambda x, bad, **_: seen.append((x, bad)) or [])
    fits = []
    for table in (rows, rows + [rows[20]] * 500):
        docs = frame(spark, table)
        R.fit_rules(docs, labels, sample_rows=len(rows))
        fits.append(S.fit_classifier(docs, labels, sample_rows=len(rows)))
    (x, bad), (y, worse) = seen
    assert len(bad) == len(rows) and (bad == worse).all() and all((x[f] == y[f]).all() for f in R.FEATURES)
    assert (fits[0][0] == fits[1][0]).all() and fits[0][1] == fits[1][1]
