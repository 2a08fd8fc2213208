"""Session helpers: building a local session for tests and finding the
shared scratch folder a job may write intermediate tables to."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lodgeframe", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured like the test and bench harnesses. The
    web UI stays off; ``extra_conf`` adds settings (e.g. an event log)."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LODGEFRAME_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this comes from ``spark.checkpoint.dir`` (a shared file
    system every executor can reach). A local session that leaves it
    unset, as in tests, gets a temporary one; any other raises an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lodgeframe-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 ** 2,
                           total_cores: int = 1) -> int:
    """A starting ``spark.sql.shuffle.partitions`` for a cluster: enough
    partitions that each holds about ``target_bytes`` of shuffled data, and
    at least two per core. Adaptive execution then coalesces small ones and
    splits skewed ones."""
    return max(2 * total_cores, -(-int(input_bytes) // target_bytes))


def apply_scale_conf(spark: SparkSession, input_bytes: int, total_cores: int) -> None:
    """Size shuffles and scans for the input, leaving AQE in charge at run
    time (coalescing, skew-join splits)."""
    spark.conf.set("spark.sql.shuffle.partitions",
                   str(shuffle_partitions_for(input_bytes, total_cores=total_cores)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024 ** 2))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024 ** 2))
