"""Shared helpers of the corpus operators: tables, scratch tables, stable row hashes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Spark's setting by which a query's shuffle files go when it ends, not when the driver next collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind; for results that are read back and not computed again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shielded(df: DataFrame, **extra: Column) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` for an operator whose own columns begin with ``_``, and the way back to the caller's names.

    Columns of ``df`` that begin so get other names meanwhile.  ``extra`` are
    computed from ``df`` and named with a ``_`` before them.
    """
    prefix = "kept"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    renamed = {c: f"{prefix}{i}{c}" for i, c in enumerate(df.columns) if c.startswith("_")}
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    inside = df.select(*[quoted(c).alias(renamed.get(c, c)) for c in df.columns], *[v.alias(f"_{k}") for k, v in extra.items()])
    back = {v: k for k, v in renamed.items()}
    return inside, lambda out: out.withColumnsRenamed(back)


def word_count(text: str | Column) -> Column:
    """Number of words; NULL text has none."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *columns: str) -> Column:
    """A number strictly between 0 and 1 from the values of ``columns`` (52 bits of MD5; any engine can repeat it)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))
