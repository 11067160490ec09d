"""Parquet sinks: dated raw partitions, staged snapshot swap, keyed upsert.

No sink forces a single output file: ``num_files`` is an explicit opt-in and,
by default, the writer parallelism follows the data (AQE coalesces small
shuffle partitions).  When a sort order is requested, rows are range
partitioned and sorted within partitions, so the file order is the total
order without funnelling the table through one task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import changed_keys
from ..operators.joins import semi_join
from ..operators.merge import upsert
from ..session import scratch_dir

DS_COLUMN = "ds"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch path once its content has been merged."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def recover_snapshot(spark: SparkSession, path: str) -> None:
    """Finish an interrupted swap: if the table is missing but a copy was moved
    aside (the driver died between the two renames), move it back."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return
    parent = target.getParent()
    if parent is None or not fs.exists(parent):
        return
    prefix = f"{target.getName()}.__retired-"
    retired = [st.getPath() for st in fs.listStatus(parent) if st.getPath().getName().startswith(prefix)]
    if retired:
        latest = max(retired, key=lambda p: fs.getFileStatus(p).getModificationTime())
        fs.rename(latest, target)


def recover_partitions(spark: SparkSession, path: str) -> None:
    """Finish interrupted partition swaps of the table at ``path``.

    A partition that was moved aside (hidden, ``.<name>.__retired-<token>``) and
    has no live sibling is moved back; one whose successor is in place is
    removed.  Called before any read of a partitioned table.
    """
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return
    found: dict[str, list] = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(".") and ".__retired-" in name:
            found.setdefault(name[1:].split(".__retired-")[0], []).append(status)
    for name, retired in found.items():
        live = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, name)
        retired.sort(key=lambda s: s.getModificationTime())
        if not fs.exists(live) and not fs.rename(retired.pop().getPath(), live):
            raise OSError(f"could not move {name} of {path} back")
        for status in retired:
            fs.delete(status.getPath(), True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """A parquet table exists when its directory holds a commit marker or files."""
    recover_snapshot(spark, path)
    recover_partitions(spark, path)
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and len(fs.listStatus(p)) > 0


def _layout(df: DataFrame, num_files: int | None, sort_by: Sequence[str] | None) -> DataFrame:
    if sort_by:
        ranged = df.repartitionByRange(num_files, *sort_by) if num_files else df.repartitionByRange(*sort_by)
        return ranged.sortWithinPartitions(*sort_by)
    if num_files:
        return df.repartition(num_files)
    return df


def write_dated_partition(
    df: DataFrame,
    root: str,
    ds: str,
    num_files: int | None = None,
) -> None:
    """Write ``df`` as partition ``ds=<ds>`` of ``root``, replacing only that
    partition, so a rerun of one run date is idempotent.

    The partition's own folder is overwritten: a rerun with no rows leaves the
    date empty (a dynamic overwrite would keep the rows of the earlier run).
    """
    _layout(df.drop(DS_COLUMN), num_files, None).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{DS_COLUMN}={ds}")


def read_dated_partition(spark: SparkSession, root: str, ds: str | None = None) -> DataFrame:
    df = spark.read.option("basePath", root).parquet(root)
    return df.filter(F.col(DS_COLUMN) == F.lit(ds).cast("date")) if ds else df


def write_snapshot(
    df: DataFrame,
    path: str,
    num_files: int | None = None,
    sort_by: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the table at ``path`` with ``df`` safely; ``options`` go to the Parquet writer.

    The new snapshot is written completely to a staging directory first and
    swapped in by two renames afterwards, so ``df`` may itself read ``path``
    (a merge) and a failed write leaves the old table untouched.
    """
    spark = df.sparkSession
    recover_snapshot(spark, path)
    token = uuid.uuid4().hex
    staging = f"{path.rstrip('/')}.__staging-{token}"
    _layout(df, num_files, sort_by).write.options(**(options or {})).mode("errorifexists").parquet(staging)
    fs, target = _fs(spark, path)
    _, staged = _fs(spark, staging)
    if fs.exists(target):
        _, retired = _fs(spark, f"{path.rstrip('/')}.__retired-{token}")
        if not fs.rename(target, retired):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(staged, target):
            fs.rename(retired, target)
            raise OSError(f"could not move {staging} into place")
        fs.delete(retired, True)
    elif not fs.rename(staged, target):
        raise OSError(f"could not move {staging} into place")


def upsert_table(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: str | Sequence[str],
    dedupe_by: str | None = None,
    num_files: int | None = None,
    sort_by: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``new`` into the parquet table at ``path`` and return the table.

    First load (no table yet) is an explicit existence test, never a
    swallowed error.
    """
    old = spark.read.parquet(path) if table_exists(spark, path) else None
    write_snapshot(upsert(new, old, keys, dedupe_by), path, num_files, sort_by)
    return spark.read.parquet(path)


def upsert_table_changes(spark: SparkSession, new: DataFrame, path: str, keys: str | Sequence[str]) -> DataFrame:
    """As ``upsert_table``, but an upsert that changes nothing writes nothing."""
    if table_exists(spark, path):
        old = spark.read.parquet(path)
        if changed_keys(new, old, keys).isEmpty():
            return old
    return upsert_table(spark, new, path, keys)


def upsert_partitioned_changes(
    spark: SparkSession, new: DataFrame, path: str, keys: str | Sequence[str], partition_col: str,
) -> DataFrame:
    """As ``upsert_partitioned``, but only partitions with an inserted or updated key are rewritten.

    A source that sends its whole history again every day then costs a read of
    it and a write of what differs.
    """
    if not table_exists(spark, path):
        return upsert_partitioned(spark, new, path, keys, partition_col)
    k = [keys] if isinstance(keys, str) else list(keys)
    old = spark.read.parquet(path)
    touched = old.filter(in_partitions(partition_col, touched_partition_values(new, partition_col)))
    found = scratch_dir(spark, "changed-keys")
    changed_keys(new.select(*old.columns), touched, k).write.parquet(found)
    changed = spark.read.parquet(found)
    if changed.isEmpty():
        return old
    return upsert_partitioned(spark, semi_join(new, changed, k), path, k, partition_col)


def upsert_partitioned(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: str | Sequence[str],
    partition_col: str,
    dedupe_by: str | None = None,
) -> DataFrame:
    """Merge ``new`` into a table partitioned by ``partition_col``, rewriting
    only the partitions ``new`` touches.

    ``partition_col`` must be a function of the key (e.g. the season of a
    game id) so a key never moves between partitions.  Only touched
    partitions are read, merged, written to a staging directory and swapped
    in one partition at a time; untouched partitions are neither read nor
    rewritten.  The touched partition values reach the driver, where they turn
    into a static partition filter, and partitions are renamed there: choose a
    ``partition_col`` of fixed cardinality (a season, a number of buckets), not
    one that grows with the rows.  An interrupted run is repaired by running it
    again: partitions left aside by a dead driver come back before the read.
    """
    spark_keys = [keys] if isinstance(keys, str) else list(keys)
    if not table_exists(spark, path):
        write_snapshot_partitioned(upsert(new, None, spark_keys, dedupe_by), path, partition_col)
        return spark.read.parquet(path)
    old = spark.read.parquet(path)
    old_touched = old.filter(in_partitions(partition_col, touched_partition_values(new, partition_col)))
    merged = upsert(new, old_touched, spark_keys, dedupe_by).select(*old.columns)
    replace_partitions(merged, path, partition_col, gather=False)
    return spark.read.parquet(path)


def touched_partition_values(df: DataFrame, partition_col: str) -> list:
    """Distinct partition values of ``df``: as many as the partition column has."""
    return [r[0] for r in df.select(partition_col).distinct().collect()]


def in_partitions(partition_col: str, values: Sequence) -> Column:
    """Static partition filter for ``values`` (NULL means the default partition)."""
    cond = F.col(partition_col).isin([v for v in values if v is not None])
    if any(v is None for v in values):
        cond = cond | F.col(partition_col).isNull()
    return cond


def table_version(spark: SparkSession, path: str) -> str:
    """Digest of a table's file names, which every rewrite changes."""
    fs, root = _fs(spark, path)
    files = sorted(st.getPath().getName() for st in fs.listStatus(root))
    return hashlib.sha256("\n".join(files).encode()).hexdigest()


def partition_versions(spark: SparkSession, path: str) -> dict[str, str]:
    """``{partition folder: digest of its file names}``; every rewrite of a partition changes its file names."""
    recover_partitions(spark, path)
    fs, root = _fs(spark, path)
    out = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name and not name.startswith((".", "_")):
            files = sorted(f.getPath().getName() for f in fs.listStatus(status.getPath()))
            out[name] = hashlib.sha256("\n".join(files).encode()).hexdigest()
    return out


def write_versions(spark: SparkSession, versions: dict[str, str], path: str) -> None:
    """Store what ``partition_versions`` gave, one small row per partition."""
    write_snapshot(spark.createDataFrame(sorted(versions.items()), "partition string, version string").coalesce(1), path)


def read_versions(spark: SparkSession, path: str) -> dict[str, str]:
    """What ``write_versions`` stored at ``path`` (nothing, if it never did)."""
    return {r.partition: r.version for r in spark.read.parquet(path).collect()} if table_exists(spark, path) else {}


def changed_partitions(spark: SparkSession, versions: dict[str, str], built: str) -> list[str]:
    """The partition folders that differ from those stored at ``built`` (all, if nothing is stored)."""
    known = read_versions(spark, built)
    return [name for name, version in versions.items() if known.get(name) != version]


def in_partition_folders(partition_col: str, names: Iterable[str]) -> Column:
    """Static partition filter for partition folders (``season=2023``)."""
    values = [unquote(n.split("=", 1)[1]) for n in names]
    cond = F.col(partition_col).cast("string").isin([v for v in values if v != NULL_PARTITION])
    return cond | F.col(partition_col).isNull() if NULL_PARTITION in values else cond


def _write_partitions(df: DataFrame, path: str, partition_col: str, gather: bool = True) -> None:
    """Write by partition with the rows of a partition in few tasks (a large one is split), so in few files.

    Without ``gather`` each task writes its own rows: a file per task and
    partition, but no second shuffle of rows that a join or aggregate has just dealt.
    """
    (df.hint("rebalance", partition_col) if gather else df).write.mode("errorifexists").partitionBy(partition_col).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_col: str, gather: bool = True) -> None:
    """Replace the partitions present in ``df`` (and only those) in the
    partitioned table at ``path``: staged write, then one rename swap per
    partition directory.  Rerunning with the same ``df`` is idempotent.
    ``gather`` as in :func:`_write_partitions`."""
    spark = df.sparkSession
    recover_partitions(spark, path)
    token = uuid.uuid4().hex
    staging = f"{path.rstrip('/')}.__staging-{token}"
    _write_partitions(df, staging, partition_col, gather)
    fs, staged_root = _fs(spark, staging)
    _, target_root = _fs(spark, path)
    if not fs.exists(target_root):
        fs.mkdirs(target_root)
    jvm = spark.sparkContext._jvm
    for status in fs.listStatus(staged_root):
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith(f"{partition_col}="):
            continue
        target = jvm.org.apache.hadoop.fs.Path(target_root, name)
        retired = jvm.org.apache.hadoop.fs.Path(target_root, f".{name}.__retired-{token}")
        if fs.exists(target) and not fs.rename(target, retired):
            raise OSError(f"could not move {target} aside")
        if not fs.rename(status.getPath(), target):
            if fs.exists(retired):
                fs.rename(retired, target)
            raise OSError(f"could not move {status.getPath()} into place")
        if fs.exists(retired):
            fs.delete(retired, True)
    fs.delete(staged_root, True)


def write_snapshot_partitioned(df: DataFrame, path: str, partition_col: str, gather: bool = True) -> None:
    """``write_snapshot`` for a table partitioned by ``partition_col``; ``gather`` as in :func:`_write_partitions`."""
    spark = df.sparkSession
    recover_snapshot(spark, path)
    token = uuid.uuid4().hex
    staging = f"{path.rstrip('/')}.__staging-{token}"
    _write_partitions(df, staging, partition_col, gather)
    fs, target = _fs(spark, path)
    _, staged = _fs(spark, staging)
    if fs.exists(target):
        _, retired = _fs(spark, f"{path.rstrip('/')}.__retired-{token}")
        if not fs.rename(target, retired):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(staged, target):
            fs.rename(retired, target)
            raise OSError(f"could not move {staging} into place")
        fs.delete(retired, True)
    elif not fs.rename(staged, target):
        raise OSError(f"could not move {staging} into place")


def write_text_sorted(lines: DataFrame, path: str, order: Sequence[str], column: str = "line") -> None:
    """Write one text column in total order (range partitions, sorted within),
    e.g. the results digest: concatenating the part files in name order gives
    the digest text.  A value's own final newline is replaced by the writer's
    line separator."""
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    text = F.regexp_replace(F.col(column), r"\n\z", "")
    ranged.select(text.alias(column)).write.mode("overwrite").text(path)
