"""JDBC source: read a published table back.

Filters and column selections on the returned DataFrame are pushed into the
database query.  For large tables pass a numeric ``partition_column`` with
bounds (or explicit ``predicates``) so the read is split across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    props: dict[str, str] = {}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    if fetch_size is not None:
        props["fetchsize"] = str(fetch_size)
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)
