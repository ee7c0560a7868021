"""Spark session helpers.

The library never hard-codes a cluster layout. ``build_session`` is a
convenience for local runs and tests; on a cluster the caller passes its
own session and the library only reads settings from it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on. Event times are compared
# as instants, so the session zone is pinned to UTC; output zones are
# explicit parameters of the formatting functions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows reach Python in batches of a few megabytes: by default a batch of long texts is tens of
    # megabytes, held several times over (JVM, pipe, Python) by every running task.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

# Python workers stay for later tasks. With these, what a task frees goes back to the system (a fixed
# threshold for blocks of their own, one arena, Arrow through malloc) and does not pile up in the workers.
WORKER_ENV = {
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def settle(spark: SparkSession) -> None:
    """Give a caller's session the settings above and make sure of a checkpoint folder."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in WORKER_ENV.items():
        spark.sparkContext.environment.setdefault(k, v)
    ensure_checkpoint_dir(spark)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20,
                   executor_cores_total: int | None = None) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` (apply them to the
    cluster's session or submit configuration).

    Shuffle partitions start high enough that one shuffle partition holds
    about ``partition_bytes`` of input-sized data (AQE coalesces small ones
    at run time and splits skewed join partitions); scans split at the same
    size. With ``executor_cores_total`` the count is at least 3 waves.
    """
    n = max(200, -(-input_bytes // partition_bytes))
    if executor_cores_total:
        n = max(n, 3 * executor_cores_total)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(8 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names this folder (a shared file system path); we only read
    it. Where it is unset, a local session (and only that) gets a fresh
    scratch folder; any other master raises, as executors could not see it.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        jdir = sc._jsc.sc().getCheckpointDir()
        current = jdir.get() if jdir.isDefined() else None
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, e.g. for a stream's state."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
