"""Session helpers: a session for tests and benches, and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "recordlog",
              driver_memory: str | None = None) -> SparkSession:
    """Session for local runs; on a cluster the caller's session is used as is."""
    master = master or os.environ.get("RECORDLOG_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory or os.environ.get("RECORDLOG_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (tests, local runs) a folder of
    our own is created and registered, so that later calls agree.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share; "
                               "a machine-local temporary folder does not work on a cluster")
        root = tempfile.mkdtemp(prefix="recordlog-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_input_bytes: int | None = None, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings we expect on a large cluster (pass to ``SparkSession.builder.config``).

    AQE re-plans joins from measured sizes, splits skewed shuffle partitions and
    coalesces small ones; the initial shuffle width is sized from the input so a
    partition fits an executor's memory before coalescing."""
    width = "2000"
    if total_input_bytes:
        width = str(max(200, int(total_input_bytes // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": width,
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.session.timeZone": "UTC",
    }
