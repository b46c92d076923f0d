"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings for a run of the pipeline. AQE re-plans joins from runtime sizes
# (broadcast only below the threshold, sort-merge beyond it), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Starting settings for a run over ``input_bytes`` on ``cores`` executor
    cores: enough initial shuffle partitions for ~256 MB each (AQE coalesces
    small ones and splits skewed join partitions), 256 MB scan splits, and a
    broadcast threshold that AQE applies to runtime sizes only."""
    target = 256 * 1024 * 1024
    partitions = max(cores * 2, input_bytes // target)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target * 2),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    }


def get_session(
    app: str = "lendlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the pipeline's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder used to cut lineage, shared by all executors.

    Taken from the session (``spark.checkpoint.dir`` or an already set
    checkpoint directory). Only a local-mode session without one (tests, a
    laptop) gets a fresh private folder; a cluster without one is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="lendlake-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
