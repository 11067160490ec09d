"""Keyed upsert of a new snapshot into the current table.

new wins on key collisions, old rows absent from new are kept, nothing is
deleted.  Columns are matched by name (never by position).  The write side
(staged write + swap) lives in :mod:`rinkstat.sinks.parquet`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import anti_join


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def dedupe_latest(df: DataFrame, keys: str | Sequence[str], order_by: str) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_by``.

    A NULL ``order_by`` is below any other; ties go to the greatest values of
    the other columns in their order, so the winner doesn't depend on how the
    rows are partitioned.  Expressed as an aggregate (``max`` of a struct) it
    combines map-side and a hot key cannot pile up in one task.
    """
    k = _keys(keys)
    rest = [c for c in df.columns if c not in k and c != order_by]
    order = F.struct(F.col(order_by).isNotNull().alias("_set"), order_by, *rest)
    picked = df.groupBy(*k).agg(F.max(order).alias("_row"))
    return picked.select(*k, "_row.*").select(*df.columns)


def split_null_keys(df: DataFrame, keys: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with a NULL key) — the latter are rejected."""
    k = _keys(keys)
    has_all = F.lit(True)
    for c in k:
        has_all = has_all & F.col(c).isNotNull()
    return df.filter(has_all), df.filter(~has_all)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Bag union matching columns by name; columns missing on a side are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def upsert(
    new: DataFrame,
    old: DataFrame | None,
    keys: str | Sequence[str],
    dedupe_by: str | None = None,
) -> DataFrame:
    """``new ∪ (old ▷ new)`` on ``keys``.

    ``old=None`` is the first load: the new snapshot becomes the table.
    ``dedupe_by`` optionally keeps one row per key in ``new`` first.
    """
    k = _keys(keys)
    if dedupe_by is not None:
        new = dedupe_latest(new, k, dedupe_by)
    if old is None:
        return new
    kept = anti_join(old, new, k)
    return union_by_name(new, kept)
