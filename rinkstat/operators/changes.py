"""Change feed of an upsert, and aggregates kept up to date by signed deltas.

The feed compares the new and the old rows of each key by NULL-safe digests in
one aggregate: per key and side a count and the sums of two 64-bit row hashes,
so its state has a fixed size, it combines map-side and a key may have several
rows.  No row is sent that isn't needed for the comparison.

An aggregate's state holds, per group, the number of rows and for each measure
the sum and the number of values that are set.  A changed key retracts its old
rows (sign -1) and adds its new ones (+1); a sum whose last value is retracted
is NULL again and a group without rows is gone, as in a rebuild.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"
#: Suffix of a state's count of set values of a measure.
SET = "__set"


def row_digests(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; NULL differs from any value, and so does its place."""
    values = [v for c in columns for v in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(lane), *values) for lane in (0, 1)]


def change_feed(new: DataFrame, old: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``(keys..., change, n_new, n_old)``, one row per key of either side.

    ``change`` is ``inserted`` (no old row), ``updated`` (the rows differ),
    ``unchanged`` (the same rows in any order) or ``kept`` (no new row).  Columns
    are matched by name; one that a side lacks counts as NULL.  NULL keys are
    one key.  Row order doesn't matter.
    """
    k = [keys] if isinstance(keys, str) else list(keys)
    both = new.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in k and c != "_new"]
    hashed = both.select(*k, "_new", *[d.cast("decimal(20,0)").alias(f"_d{i}") for i, d in enumerate(row_digests(rest))])
    of = lambda side, d: F.sum(F.when(F.col("_new") == side, F.col(d)).otherwise(F.lit(0)))
    same = (of(1, "_d0") == of(0, "_d0")) & (of(1, "_d1") == of(0, "_d1"))
    feed = hashed.groupBy(*k).agg(
        F.sum("_new").alias("n_new"), F.sum(1 - F.col("_new")).alias("n_old"), same.alias("_same")
    )
    change = (
        F.when(F.col("n_old") == 0, INSERTED).when(F.col("n_new") == 0, KEPT)
        .when(F.col("_same") & (F.col("n_new") == F.col("n_old")), UNCHANGED).otherwise(UPDATED)
    )
    return feed.select(*k, change.alias("change"), "n_new", "n_old")


def changed_keys(new: DataFrame, old: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The keys that an upsert of ``new`` would change."""
    k = [keys] if isinstance(keys, str) else list(keys)
    return change_feed(new, old, k).filter(F.col("change").isin(INSERTED, UPDATED)).select(*k)


def _numbers(measures: Sequence[str], count: str, sign: Column) -> dict[str, Column]:
    """The state of one row of the given sign."""
    of_set = lambda c: F.when(F.col(c).isNotNull(), sign).otherwise(F.lit(0)).cast("long")
    return {
        "_rows": sign, count + SET: of_set(count),
        **{m: F.coalesce(sign * F.col(m).cast("long"), F.lit(0).cast("long")) for m in measures},
        **{m + SET: of_set(m) for m in measures},
    }


def _rows_as_state(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str, sign: int) -> DataFrame:
    return rows.select(*keys, *[v.alias(n) for n, v in _numbers(measures, count, F.lit(sign).cast("long")).items()])


def _summed(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in states.columns if c not in keys])


def aggregate_state(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str) -> DataFrame:
    """The state of ``count(count), sum(measures...)`` by ``keys`` over ``rows``."""
    return _summed(_rows_as_state(rows, keys, measures, count, 1), keys)


def apply_deltas(
    state: DataFrame, retracted: DataFrame, added: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str,
) -> DataFrame:
    """``state`` after ``retracted`` rows left and ``added`` rows came; no other row is read.

    State and signed rows meet in one aggregate, which sums them up before its
    only shuffle.  Groups left without rows are dropped; NULL keys are a group
    like any other.
    """
    deltas = [_rows_as_state(rows, keys, measures, count, sign) for rows, sign in ((added, 1), (retracted, -1))]
    both = state.unionByName(deltas[0]).unionByName(deltas[1])
    return _summed(both, keys).filter("_rows <> 0")


def aggregate_of(state: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str, name: str) -> DataFrame:
    """The aggregate that a state stands for: the count as ``name``, and a sum of nothing is NULL."""
    return state.select(
        *keys, F.col(count + SET).alias(name), *[F.when(F.col(m + SET) > 0, F.col(m)).alias(m) for m in measures]
    )


def split_changes(new: DataFrame, old: DataFrame, keys: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(retracted, added)``: the old and the new rows of the keys that an upsert changes.

    Both sides are shuffled once, together, and compared where they meet; the
    two results read that one exchange.  Columns are those of ``old``, by name.
    NULL keys match none, so their rows are in neither result.
    """
    k = [keys] if isinstance(keys, str) else list(keys)
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    both = new.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    rest = [c for c in columns if c not in k]
    # Digests go along, not the columns that only they need.
    digests = [d.alias(f"_d{i}") for i, d in enumerate(row_digests(rest))]
    both = both.dropna(subset=k).select(*columns, "_new", *digests)
    side = 2 * F.col("_new") - 1
    of_key = Window.partitionBy(*k)
    differs = F.sum(side).over(of_key) != 0
    for i in range(len(digests)):
        differs = differs | (F.sum(side * F.col(f"_d{i}").cast("decimal(20,0)")).over(of_key) != 0)
    changed = (F.max("_new").over(of_key) == 1) & differs
    marked = both.withColumn("_changed", changed).filter("_changed").drop("_changed")
    of_side = lambda n, names: marked.filter(F.col("_new") == n).select(*names)
    return of_side(0, old.columns), of_side(1, new.columns)
