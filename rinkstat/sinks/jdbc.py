"""JDBC sink: publish a table to a relational database.

Connection settings (URL, user, password, driver class) come only from the
caller; nothing is read from files or the environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    num_partitions: int | None = None,
    batch_size: int | None = None,
    truncate: bool = False,
    extra_options: dict[str, str] | None = None,
) -> None:
    """Write ``df`` to ``table``.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it);
    ``truncate`` keeps the existing table definition on overwrite instead of
    dropping and recreating it.
    """
    options = {"url": url, "dbtable": table}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if driver is not None:
        options["driver"] = driver
    if num_partitions is not None:
        options["numPartitions"] = str(num_partitions)
    if batch_size is not None:
        options["batchsize"] = str(batch_size)
    if truncate:
        options["truncate"] = "true"
    options.update(extra_options or {})
    df.write.format("jdbc").mode(mode).options(**options).save()
