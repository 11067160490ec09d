"""Session and scratch-space helpers.

The library itself never builds a session; these helpers are for tests, the
bench and command-line use.  ``scratch_dir`` always prefers the shared folder
the cluster names in ``spark.checkpoint.dir`` and only falls back to a local
temporary folder when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Sensible defaults for a large cluster; local runs override the parallelism.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "rinkstat",
    shuffle_partitions: int = 8,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    If none is set, a local one is made on a ``local`` master only (tests); any
    other master raises, since its machines share no temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(
            f"spark.checkpoint.dir is not set and the master is {master}: a folder of this machine would be "
            "unseen by the others; name a shared one in spark.checkpoint.dir"
        )
    local = tempfile.mkdtemp(prefix="rinkstat-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "rinkstat", f"{label}-{uuid.uuid4().hex}")


def cluster_conf(
    input_bytes: int,
    total_cores: int,
    executor_memory_gb: float = 16.0,
    executor_cores: int = 4,
    bytes_per_partition: int = 512 * 1024 * 1024,
) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of parquet.

    Shuffle partitions start at one per ``bytes_per_partition`` of input (never
    fewer than two per core); AQE then coalesces them to ``advisoryPartitionSizeInBytes``
    and splits skewed ones.  The per-task memory budget bounds the advisory
    size so a partition fits in executor memory with room for spills.
    """
    mb = 1024 * 1024
    per_task_mb = max(64, int(executor_memory_gb * 1024 * 0.6 / max(1, executor_cores)))
    advisory_mb = min(256, per_task_mb // 2)
    partitions = int(max(2 * total_cores, input_bytes // bytes_per_partition))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * advisory_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{min(256, 2 * advisory_mb)}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        # A join's filtered side of up to 64 MB becomes a Bloom filter over scans from 1 GB, so that
        # payloads of unknown keys are dropped before they are shuffled or parsed.
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }
