"""Mixing sources to target weights by weighted sampling without replacement.

Every source gets a budget of words.  Whole epochs of a source come first; the
rest of its budget is filled in Efraimidis-Spirakis order: each document draws
the key ``-ln(u) / weight`` and the smallest keys are taken until the budget is
used.

No source is sorted in one task.  Keys fall into narrow buckets of equal ratio,
whatever the weights; one sum per source and bucket tells in which bucket the
budget ends.  That bucket is cut evenly into parts of some thousand rows, whose
sums tell the part, and only this part is sorted, which gives the source's last
key that is taken and how many rows equal to it.  The plan is one small row per
source; applying it is a join with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shielded, stored, uniform
from .merkle import numbered

#: Documents of a part of a bucket, on average.
BUCKET_ROWS = 2000
#: Buckets to each doubling of the key.
BINS = 64
SEED = 20


def source_targets(
    docs: DataFrame,
    size: str,
    source: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """``(source, source_size, n_docs, target)``: one row per source.

    Sources by code point (NULL last) weigh ``weights`` in turn and share
    ``share`` times all words.  A target stops at ``most`` times its source's
    size, and what is over is shared again by weight until none is above.  With
    the sources ordered by cap over weight the capped ones come first, so the
    final level follows from prefix sums; the windows hold a row per source.
    """
    sums = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    sums = sums.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    sums = sums.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    here_on = order.rowsBetween(0, W.unboundedFollowing)
    # If all sources before this one are capped, the others share what is left.
    left = F.lit(float(share) - float(most)) * F.sum("source_size").over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ) + F.sum("_cap").over(here_on)
    sums = sums.withColumn("_level", left / F.sum("_w").over(here_on))
    level = F.first(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return sums.withColumn("_level", level).select(
        "source", "source_size", "n_docs",
        F.coalesce(F.least(F.col("_cap"), F.col("_level") * F.col("_w")), F.col("_cap")).alias("target"),
    )


def _keyed(docs: DataFrame, totals: DataFrame, weight: Column, source: str, keys: tuple[str, ...], seed: int) -> DataFrame:
    """``docs`` with their key and its bucket: ``BINS`` to each doubling of the key, so a bucket is narrow for any weight."""
    weight = F.greatest(F.coalesce(weight.cast("double"), F.lit(1e-6)), F.lit(1e-6))
    return (
        docs.withColumn("_key", -F.log(uniform(seed, *keys)) / weight)
        .join(totals, F.col(source).eqNullSafe(F.col("_source")), "inner")
        .withColumn("_bucket", F.floor(BINS * F.log2("_key")))
    )


def _fine(parts: Column) -> Column:
    """Which of ``parts`` equal parts of its bucket a key lies in; within a bucket keys are spread nearly evenly."""
    low, high = F.pow(F.lit(2.0), F.col("_bucket") / BINS), F.pow(F.lit(2.0), (F.col("_bucket") + 1) / BINS)
    at = F.floor(parts * (F.col("_key") - low) / (high - low))
    return F.least(F.greatest(at, F.lit(0)), parts - 1)


def _end_of(rows: DataFrame, number: str, size: str, start: Column, name: str) -> DataFrame:
    """Per source the bucket where the budget ends, the words before it and its rows."""
    before = W.partitionBy("_source").orderBy(number).rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("_source", "_rest", number, start.alias("_start")).agg(F.sum(size).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    return stored(
        sums.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .filter((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_sum") > F.col("_rest")))
        .select(F.col("_source").alias(f"{name}_source"), F.col(number).alias(name), F.col("_before").alias(f"{name}_before"), F.col("_n").alias(f"{name}_n")),
        "mix-ends",
    )


def mix_plan(
    docs: DataFrame,
    size: str,
    weight: Column,
    source: str = "source",
    keys: tuple[str, ...] = ("doc_id",),
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    **shares,
) -> DataFrame:
    """One row per source: its target, whole epochs, the last key taken beyond them (``_cut``) and how many rows equal to it (``_fit``)."""
    totals = stored(
        source_targets(docs, size, source, **shares).select(
            F.col("source").alias("_source"), "source_size", "target",
            F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).alias("_epochs"),
        ).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")),
        "mix-totals",
    )
    keyed = _keyed(docs.select(source, size, *keys, weight.alias("_weight")), totals, F.col("_weight"), source, keys, seed)
    ends = _end_of(keyed, "_bucket", size, F.lit(0), "_end")
    ends = ends.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_end_n") / bucket_rows)).cast("long"))
    inside = keyed.join(ends, F.col("_source").eqNullSafe(F.col("_end_source")) & (F.col("_bucket") == F.col("_end")), "inner")
    inside = inside.withColumn("_part", _fine(F.col("_parts")))
    parts = _end_of(inside, "_part", size, F.col("_end_before"), "_last")
    order = W.partitionBy("_source").orderBy("_key", *keys, size).rowsBetween(W.unboundedPreceding, 0)
    middle = F.col("_last_before") + F.sum(size).over(order) - F.col(size) / 2  # nearer to the budget with it than without
    cuts = (
        inside.join(parts, F.col("_source").eqNullSafe(F.col("_last_source")) & (F.col("_part") == F.col("_last")), "inner")
        .withColumn("_middle", middle)
        .filter(F.col("_middle") <= F.col("_rest"))
        .groupBy(F.col("_source").alias("_cut_source"), F.struct("_key", *keys, size).alias("_cut")).agg(F.count(F.lit(1)).alias("_fit"))
        .groupBy("_cut_source").agg(F.max(F.struct("_cut", "_fit")).alias("_taken"))
        .select("_cut_source", "_taken.*")
    )
    same = lambda name: F.col("_source").eqNullSafe(F.col(name))
    return stored(
        totals.join(ends, same("_end_source"), "left").join(parts, same("_last_source"), "left").join(cuts, same("_cut_source"), "left")
        .drop("_end_source", "_last_source", "_cut_source", "_end_before", "_last_before", "_end_n", "_last_n"),
        "mix-plan",
    )


def apply_mix(
    docs: DataFrame, plan: DataFrame, size: str, weight: Column,
    source: str = "source", keys: tuple[str, ...] = ("doc_id",), seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``taken`` (words taken, repeats counted).

    ``taken`` is a whole multiple of the document's size.  The last document of
    a budget is taken when that brings its source nearer to its target.  Empty
    documents take 0.  A weight that is NULL or not above 0 counts as 1e-6.
    Ties of the key go by the key columns, then size; of rows equal in all of
    these as many are taken as fit, in the order of a hash of the whole row.
    NULL is a source of its own.  An empty table gives an empty result; columns
    of these three names in ``docs`` are replaced, any others kept (``source``,
    ``size`` and ``keys`` don't begin with ``_``).
    """
    docs, back = shielded(docs.drop("source_size", "target", "taken"), weight=weight)
    own = [c for c in docs.columns if c != "_weight"]
    keyed = _keyed(docs, plan, F.col("_weight"), source, keys, seed).withColumn("_part", _fine(F.col("_parts")))
    place = F.struct("_key", *keys, size)
    at_end, at_last = F.col("_bucket") == F.col("_end"), F.col("_part") == F.col("_last")
    equal = F.coalesce(at_end & at_last & (place == F.col("_cut")), F.lit(False))
    below = (F.col("_bucket") < F.col("_end")) | (
        at_end & ((F.col("_part") < F.col("_last")) | (at_last & F.coalesce(place < F.col("_cut"), F.lit(False))))
    )
    below = (F.col("_rest") > 0) & F.when(F.col("_end").isNull(), F.lit(True)).otherwise(F.coalesce(below, F.lit(False)))
    keep = [*own, "source_size", "target"]
    times = lambda more: (F.col(size) * (F.col("_epochs") + F.when(more, 1).otherwise(0))).cast("long").alias("taken")
    # Copies of the last document taken are numbered by ranges, so a hot row isn't numbered in one task.
    last = keyed.filter(equal).withColumn("_hash", F.xxhash64(*own))
    last = numbered(last.select(*keep, "_source", "_epochs", "_rest", "_fit", "_hash"), "_source", "_hash")
    fits = (F.col("_rest") > 0) & (F.col("_place") < F.col("_fit"))
    return back(keyed.filter(~equal).select(*keep, times(below)).unionByName(last.select(*keep, times(fits))))
