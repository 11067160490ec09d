import numpy as np
from pyspark.sql import functions as F

from rinkstat.llm import queries, site_quality

from .data import documents, frame


def strength(n, s, prior):
    p = np.clip(prior, 1e-6, 1 - 1e-6)
    spread, noise = (n * (s / n - p) ** 2).sum(), (p * (1 - p) * np.ones_like(n)).sum()
    if spread <= noise:
        return site_quality.MOST_STRENGTH
    between = (spread - noise) / n.sum()
    return min(max((n * p * (1 - p)).sum() / n.sum() / between - 1, 1e-3), site_quality.MOST_STRENGTH)


def brute(rows):
    """``{(host, path): (host posterior, path posterior)}`` and the global rate from ``(host, path, p)`` rows."""
    paths, hosts = {}, {}
    for h, q, p in rows:
        for table, k in ((paths, (h, q)), (hosts, h)):
            n, s = table.get(k, (0, 0.0))
            table[k] = (n + 1, s + round(p * 1e6) / 1e6)
    n, s = np.array([v[0] for v in hosts.values()], float), np.array([v[1] for v in hosts.values()])
    rate = min(max(s.sum() / n.sum(), 1e-6), 1 - 1e-6)
    k = strength(n, s, np.full(len(n), rate))
    host = {h: (s + k * rate) / (n + k) for h, (n, s) in hosts.items()}
    n, s = np.array([v[0] for v in paths.values()], float), np.array([v[1] for v in paths.values()])
    k = strength(n, s, np.array([host[h] for h, _ in paths]))
    return {hq: (host[hq[0]], (v[1] + k * host[hq[0]]) / (v[0] + k)) for hq, v in paths.items()}, rate


def test_posteriors_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(None if h == 3 else f"h{h}", None if q == 1 else f"p{q}", float(np.clip(rng.normal(0.2 + 0.1 * h, 0.2), 0, 1)))
            for h in range(6) for q in range(3) for _ in range(1 + 4 * h * q)]
    sites, rate = site_quality.site_posteriors(spark.createDataFrame(rows, "source string, lang string, p_doc double"), "source", "lang")
    want, want_rate = brute(rows)
    got = {(r["_host"], r["_path"]): (r.host_posterior, r.path_posterior) for r in sites.collect()}
    assert got.keys() == want.keys() and abs(rate - want_rate) < 1e-9
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_sparse_sites_are_shrunk(spark):
    rows = [("big", "x", 0.9)] * 400 + [("bad", "x", 0.1)] * 400 + [("tiny", "x", 0.1)]
    sites, rate = site_quality.site_posteriors(spark.createDataFrame(rows, "source string, lang string, p_doc double"), "source", "lang")
    post = {r["_host"]: r.path_posterior for r in sites.collect()}
    assert post["bad"] < post["tiny"] < rate < post["big"]


def test_logistic_finds_a_plane():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    good = (x @ [2.0, -1.0, 0.0] + 0.5 > 0).astype(float)
    w, b = site_quality.fit_logistic(x, good)
    assert (((x @ w + b) > 0) == good).mean() > 0.97


def test_query_and_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = site_quality.classify(docs, labels.filter("doc_id % 5 <> 0")).toPandas()
    want, rate = brute(list(zip(got["source"], got["lang"], got["p_doc"], strict=True)))
    assert np.allclose(got["path_posterior"], [want[k][1] for k in zip(got["source"], got["lang"], strict=True)])
    logit = lambda p: np.log(p / (1 - p))
    final = logit(got["p_doc"].clip(1e-9, 1 - 1e-9)) + logit(got["path_posterior"]) - logit(rate)
    assert (got["kept"] == ((final >= -1e-12) & (got["n_words"] > 0))).mean() > 0.9999
    held = got.merge(labels.filter("doc_id % 5 = 0").toPandas(), on="doc_id")
    good = held["quality"] == 1
    assert held["kept"][good].mean() > 0.97
    assert held["kept"][~good].mean() < 0.15


def test_nulls_clashes_and_empty_tables(spark):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*documents(), (None, None, None, None, None)]).withColumn("kept", F.lit("clash"))
    got = site_quality.classify(docs, labels).collect()
    assert len(got) == len(documents()) + 1
    assert all(0 <= r.p_quality <= 1 and not (r.kept and r.n_words == 0) for r in got)
    assert site_quality.classify(frame(spark, []), labels.limit(0)).count() == 0
    assert {r.p_doc for r in site_quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_registered(spark):
    assert queries.QUERIES["op7_site_quality"](spark, "/root/testdata/sf0.001").count() == 200
