"""Session construction and the shared scratch location.

Everything durable (checkpoints, versioned tables, CSV exports made by the
registered queries) goes below the folder the cluster names in
``spark.checkpoint.dir``.  A private temporary folder is created only when
the session has none configured and runs on a ``local`` master, as in tests;
on a cluster such a folder would be another one on each machine, so a
missing setting is an error there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL configuration.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Broadcast policy: never from a static size estimate (file sizes can
    # hide a 10x expansion); only explicit broadcasts behind a row-count
    # probe, or AQE's run-time switch from measured shuffle output sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "widelines",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured for the wide-table jobs."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _private_dir(master: str) -> str:
    """A temporary folder of this machine, for ``local`` masters (driver and executors are one process)."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="widelines-ckpt-", dir="/tmp")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only if unset.

    Order: the SparkContext's checkpoint folder, then ``spark.checkpoint.dir``
    from the configuration, then (on a ``local`` master only) a private
    temporary folder.  Sessions without a SparkContext handle (Spark Connect)
    must have the setting.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        else:
            sc.setCheckpointDir(_private_dir(sc.master))
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/widelines/{label}-{uuid.uuid4().hex[:12]}"
