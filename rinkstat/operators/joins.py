"""Joins: anti-joins for the merge, fact-to-dimension and role-playing joins.

No join hints are given: Catalyst broadcasts a side only when its size
estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks
the real shuffle size at runtime, so a dimension that outgrows the threshold
falls back to a shuffled join instead of overflowing executor memory.  Hot
keys on the fact side are split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def anti_join(old: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key does not occur in ``new``."""
    k = _keys(keys)
    return old.join(new.select(*k), on=k, how="left_anti")


def semi_join(df: DataFrame, known: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``known`` (the known-key driving set)."""
    k = _keys(keys)
    return df.join(known.select(*k), on=k, how="left_semi")


def left_join_dimension(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Fact rows with their dimension attributes; unmatched facts keep NULLs."""
    return fact.join(dim, on=_keys(keys), how="left")


def role_playing_join(
    fact: DataFrame,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    roles: Mapping[str, str],
) -> DataFrame:
    """Join one small dimension several times under different roles.

    ``roles`` maps a fact column holding the dimension key to the output column
    that receives ``dim_value``.  Each role projects only (key, value), so the
    three scans share one exchange (``ReusedExchange``).
    """
    out = fact
    for fact_key, out_col in roles.items():
        lookup = dim.select(
            F.col(dim_key).alias(fact_key), F.col(dim_value).alias(out_col)
        )
        out = out.join(lookup, on=fact_key, how="left")
    return out
