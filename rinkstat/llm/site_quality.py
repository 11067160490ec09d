"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

A logistic classifier on text statistics gives each document its own evidence.
Its probabilities, summed over all documents of a host and of a path within the
host, are soft counts of good documents.  A host's rate is shrunk toward the
global rate, a path's toward its host's, by Beta priors whose strengths are
fitted to the spread of the rates (method of moments), so a sparse site says
little and a large one speaks for itself.  A document's final log odds are its
own plus what its path's posterior adds to the global prior.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .decision_rules import FEATURES, SAMPLE_ROWS, training_rows, with_statistics

#: Probabilities are summed as whole millionths, so sums don't depend on their order.
UNIT = 1_000_000
MOST_STRENGTH = 1e6


def _inputs() -> dict[str, str]:
    """Inputs of the classifier: the logarithm of one plus each ratio, and of the share of lines a word fills."""
    return {f: f"ln(1 + 20 * ({e}))" for f, e in FEATURES.items()}


def fit_logistic(x: np.ndarray, good: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method on standardised inputs, with a ridge penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-12, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = ridge * len(x) * np.diag([1.0] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (good - p) - penalty @ w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, grad)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def fit_classifier(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Trains on at most ``sample_rows`` labelled documents, those of smallest hash; without both labels it says 0.5."""
    sample = training_rows(docs, labels, _inputs(), text, key, label, sample_rows, seed)
    good = (sample["_good"] > 0).to_numpy(float)
    if not len(sample) or good.min() == good.max():
        return np.zeros(len(FEATURES)), 0.0
    return fit_logistic(sample[list(FEATURES)].to_numpy(float), good)


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))


def _logit(p: Column) -> Column:
    return F.log(p) - F.log(1 - p)


def _strength(sums: DataFrame, prior: Column) -> float:
    """The Beta strength under which groups ``(n, s)`` scatter as they do around ``prior``.

    The variance of the rates beyond that of a binomial draw is what the groups
    differ by; no such excess means full pooling (``MOST_STRENGTH``).
    """
    p = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
    noise = p * (1 - p)
    r = sums.select(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - p, 2)).alias("spread"), F.sum(noise).alias("noise"),
        F.sum("n").alias("n"), F.sum(F.col("n") * noise).alias("scale"),
    ).first()
    if r.n is None or r.spread <= r.noise:
        return MOST_STRENGTH
    between = (r.spread - r.noise) / r.n
    return float(min(max(r.scale / r.n / between - 1, 1e-3), MOST_STRENGTH))


def site_posteriors(scored: DataFrame, host: str, path: str, probability: str = "p_doc") -> tuple[DataFrame, float]:
    """``(host, path, host_posterior, path_posterior)`` and the global rate, from sums per path and host."""
    units = F.round(F.col(probability) * UNIT).cast("long")
    paths = stored(
        scored.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path"))
        .agg(F.count(F.lit(1)).alias("n"), (F.sum(units) / UNIT).alias("s")),
        "site-sums",
    )
    total = paths.select(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = min(max(total.s / total.n, 1e-6), 1 - 1e-6) if total.n else 0.5
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k = _strength(hosts, F.lit(rate))
    hosts = hosts.select(F.col("_host").alias("_h"), ((F.col("s") + k * rate) / (F.col("n") + k)).alias("host_posterior"))
    placed = stored(paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h"), "site-hosts")
    k = _strength(placed, F.col("host_posterior"))
    posterior = (F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)
    return stored(placed.select("_host", "_path", "host_posterior", posterior.alias("path_posterior")), "site-paths"), rate


def classify(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", text: str = "text", key: str = "doc_id",
    cut: float = 0.5, **options,
) -> DataFrame:
    """``(key, host, path, n_words, p_doc, host_posterior, path_posterior, p_quality, kept)`` per row of ``docs``.

    ``kept`` says whether ``p_quality`` reaches ``cut``; texts without words
    (NULL, empty, blank) are not kept.  NULL hosts and paths are sites of their
    own.  Repeated rows count as often as they occur.  An empty table stays empty.
    """
    weights, bias = fit_classifier(docs, labels, text, key, **options)
    logit = F.lit(bias)
    for weight, expr in zip(weights, _inputs().values(), strict=True):
        logit = logit + F.lit(float(weight)) * F.expr(expr)
    rows = with_statistics(docs.select(key, host, path, text), text, drop_text=True)
    scored = stored(rows.select(key, host, path, "n_words", _probability(logit).alias("p_doc")), "document-scores")
    sites, rate = site_posteriors(scored, host, path)
    clip = lambda c: F.least(F.greatest(F.col(c), F.lit(1e-9)), F.lit(1 - 1e-9))
    final = _probability(_logit(clip("p_doc")) + _logit(clip("path_posterior")) - _logit(F.lit(rate)))
    same_site = F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path"))
    return (
        scored.join(sites, same_site).drop("_host", "_path").withColumn("p_quality", final)
        .withColumn("kept", (F.col("p_quality") >= cut) & (F.col("n_words") > 0))
    )
