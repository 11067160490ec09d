"""Keyed history in buckets: merges and anti-joins that don't shuffle it.

A table is written in a fixed number of buckets of its key, one sorted file a
bucket.  Whatever joins it on that key is brought to its buckets; the table
itself is read where it lies, so a day's merge costs one shuffle of the day.
The rows of one key share a bucket, as any keyed merge needs.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import anti_join
from ..operators.merge import union_by_name
from ..session import scratch_dir


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _save(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, keys: str | Sequence[str], buckets: int) -> DataFrame:
    """``df`` as the new table ``name`` under ``path``: one file per bucket of ``keys``.

    An existing table of that name raises.  Rows with a NULL key get a bucket too.
    """
    k = _keys(keys)
    return _save(df.repartition(buckets, *k), name, path, k, buckets)


def buckets_for(df: DataFrame, least: int, rows: int) -> int:
    """As many buckets as keep each at about ``rows`` rows, so that a task's memory doesn't grow with the table."""
    return max(least, math.ceil(df.count() / rows))


def bucket_count(spark: SparkSession, name: str) -> int:
    """Into how many buckets a table is cut."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    if told is None:
        raise ValueError(f"{name} is not bucketed")
    return int(told["data_type"])


def landed_beside(new: DataFrame, history: str, keys: str | Sequence[str]) -> DataFrame:
    """``new`` computed once and stored in the buckets of the table ``history``, for joins without another shuffle."""
    spark = new.sparkSession
    path = scratch_dir(spark, "landed")
    return write_bucketed(new, f"landed_{uuid.uuid4().hex}", path, keys, bucket_count(spark, history))


def anti_join_bucketed(history: str, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of the bucketed table ``history`` whose key does not occur in ``new``; the history isn't shuffled."""
    k = _keys(keys)
    spark = new.sparkSession
    return anti_join(spark.table(history), new.select(*k).repartition(bucket_count(spark, history), *k), k)


def _merged(landed: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    return union_by_name(landed, anti_join(history, landed.select(*keys).hint("merge"), keys))


def merge_bucketed(new: DataFrame, history: str, name: str, path: str, keys: str | Sequence[str]) -> DataFrame:
    """``new ∪ (history ▷ new)`` as the table ``name`` under ``path``, in the same buckets.

    ``new`` is landed once in those buckets; neither the join nor the write
    shuffles the history.  The join is a merge of buckets even where ``new`` could
    be broadcast, so that a task reads one whole bucket and writes it as one file;
    what ``new`` adds beside it is joined into that file by the next merge.
    ``history`` stays as it is, so a failed merge can be repeated and readers keep
    what they read.
    """
    k = _keys(keys)
    spark = new.sparkSession
    return _save(_merged(landed_beside(new, history, k), spark.table(history), k), name, path, k, bucket_count(spark, history))
