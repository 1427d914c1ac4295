"""Session helpers.

Library code never creates a session of its own; it takes the caller's.
``local_session`` is for tests, the bench and the command line only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "metroflow") -> SparkSession:
    """A local session with the settings the tests and the bench assume."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("METROFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root folder for checkpoints, snapshots and stream landing files.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``,
    which must be set. Only a local session that has none (tests) gets one,
    under the system temp folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_KEY, None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="metroflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int = 256 << 20, broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of Parquet.

    Scan splits and shuffle partitions target ``partition_bytes``; AQE starts
    from enough shuffle partitions for the largest exchange (a projected,
    partially aggregated share of the input, taken as a quarter here) and
    coalesces the rest at run time. Broadcasts happen only below
    ``broadcast_bytes`` of measured size. Pure computation: apply it with
    ``SparkSession.builder.config(map=...)`` or ``spark-submit --conf``.
    """
    slots = executors * cores_per_executor
    shuffle_bytes = input_bytes // 4
    initial = max(3 * slots, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # commit each batch's state changes, not whole state snapshots, to the checkpoint
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
