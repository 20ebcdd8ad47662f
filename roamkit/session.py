"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: AQE re-plans joins and coalesces / splits skewed
# shuffle partitions at run time; UTC keeps dates stable across hosts.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roamkit") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ROAMKIT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Apply the run-time SQL settings of ``SCALE_CONF`` to an existing session."""
    for k, v in SCALE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a private folder created
    and registered, so checkpoint() and our versioned tables have a home.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return str(jdir.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share (e.g. on the cluster's "
                           "distributed file system); a machine-local folder is only used in local mode")
    path = tempfile.mkdtemp(prefix="roamkit-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return str(spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20,
                  floor: int = 200) -> int:
    """Set ``spark.sql.shuffle.partitions`` for the data at hand and return it.

    About one partition per ``target_bytes`` of input, so a partition fits in an
    executor's memory without spilling; AQE coalesces the ones that come out
    small.  There is no ceiling: a partition stays near ``target_bytes`` at any size.
    """
    n = min(max(floor, -(-input_bytes // target_bytes)), 2**31 - 1)  # the setting is a 32-bit number
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
