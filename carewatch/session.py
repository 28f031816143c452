"""SparkSession helpers.

The library never creates a session on its own inside operators; jobs receive one.
`get_spark` is for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # legacy-encoded (cp1252) CSV extracts are a real source format (A3)
    "spark.sql.legacy.javaCharsets": "true",
    "spark.driver.memory": os.environ.get("CAREWATCH_DRIVER_MEMORY", "8g"),
}


def get_spark(app: str = "carewatch", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the session names in `spark.checkpoint.dir`. Only where driver and
    tasks are one process (tests) is a private scratch folder created when none is configured;
    on any cluster a missing setting is an error, never a machine-local fallback."""
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master  # `local-cluster[...]` has executors of its own
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        d = tempfile.mkdtemp(prefix="carewatch-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Cluster sizing for a run over `input_bytes` of columnar input on `total_cores`.

    * scan splits of ~256 MB (`spark.sql.files.maxPartitionBytes`), so a task's input fits
      comfortably in executor memory after decompression;
    * an initial shuffle width of max(2 x cores, input / 1 GB) (a
      shuffle carries pruned columns and partial aggregates, far less than the raw
      input); AQE coalesces it towards
      128 MB partitions and splits (skew join) a partition 5x the median and over
      256 MB - the case of one key holding a third of the rows;
    * broadcasts only under 64 MB of measured size.
    Apply with `SparkSession.builder.config(map=...)` or `spark.conf.set` per key."""
    import math
    shuffle = max(2 * total_cores, math.ceil(input_bytes / (1 << 30)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
