"""Session settings every operator relies on, pinned in one place."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Semantics the operators depend on: calendar days are UTC days
# and malformed input raises instead of silently becoming null (X1).
PINNED_SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions, demote sort-merge joins to broadcast when a side turns out tiny.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # top-n per group keeps its partial limit for any n up to this
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


# Broadcast policy: never on a planning-time *estimate* (parquet file sizes
# can understate memory size many times over).  Sides are broadcast either
# after the library measured them (``operators.join``) or by AQE from the
# bytes a finished shuffle stage actually wrote.
JOIN_POLICY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}
MEASURED_BROADCAST_LIMIT = 10 * 1024 * 1024


def ensure_semantics(spark: SparkSession) -> SparkSession:
    """Set the pinned settings and the broadcast policy on an existing
    session (idempotent)."""
    for key, value in {**PINNED_SEMANTICS, **JOIN_POLICY}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "bookdemand",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pinned semantics and AQE on.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces downwards); tests pass ``local[*]`` and 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", "spark.cleaner.referenceTracking.cleanCheckpoints": "true", **PINNED_SEMANTICS, **ADAPTIVE, **JOIN_POLICY}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return ensure_semantics(spark)


def scale_settings(
    input_bytes: int,
    total_cores: int,
    *,
    split_bytes: int = 256 << 20,
    shuffle_partition_bytes: int = 200 << 20,
) -> dict[str, str]:
    """Spill-aware sizing for a job reading ``input_bytes`` on ``total_cores``.

    Scan splits of ``split_bytes``; an initial shuffle width that gives each
    reduce task about ``shuffle_partition_bytes`` of the input (at least two
    waves of the cluster), which AQE then
    coalesces towards its advisory size and splits where a partition is
    skewed.  Example: 100 TB on 8,000 cores → 500,000 shuffle partitions.
    """
    wanted = -(-input_bytes // shuffle_partition_bytes)
    partitions = max(2 * total_cores, wanted)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def size_to_input(spark: SparkSession, *paths: str) -> dict[str, str]:
    """Set :func:`scale_settings` for the bytes under ``paths`` and the session's
    cores; returns what was set."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    settings = scale_settings(total, spark.sparkContext.defaultParallelism)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming state.

    The cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only when it is unset and the master is local (a laptop or a test) a
    private local folder is made; on a cluster an unset folder is an error,
    because executors could not read what the driver or another one wrote.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="bookdemand-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local)."""
    import uuid

    base = checkpoint_dir(spark)
    leaf = "-".join(parts + (uuid.uuid4().hex[:12],))
    return f"{base}/bookdemand/{leaf}" if "://" in base else os.path.join(base, "bookdemand", leaf)
