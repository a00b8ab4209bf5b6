"""Spark session defaults and the shared working folder.

The engine never hard-codes a machine-local scratch path: anything that must
survive an executor loss (streaming checkpoints, stored metric tables written
by a job and read back) lives below ``spark.checkpoint.dir``, which on a
cluster names a shared file system. Only a session in local mode that names
none (tests) gets a folder of its own; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the engine should carry. AQE re-plans shuffles at
# run time (partition coalescing, skew-join splitting); UTC keeps window
# boundaries and timestamp literals identical on every executor.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", app_name: str = "transitlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` must be chosen before the first streaming query
    starts: stateful operators keep that many state partitions for the life
    of their checkpoint.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Read from the session; set our own only when it is unset in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder; ``unique`` adds a fresh leaf."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex)
    return "/".join([root, *leaf])


def cluster_conf(input_bytes: float, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20, shuffle_ratio: float = 0.5,
                 streaming_state: bool = False) -> dict[str, str]:
    """Settings that size tasks for a given input on a given cluster.

    * scan splits of ``target_partition_bytes`` (default 256 MB): a 100 TB
      input gives ~400k scan tasks that each fit an executor core's memory;
    * initial shuffle partitions sized for ``shuffle_ratio`` × input at the
      same target size (at least 3 per core), which AQE then coalesces to the
      advisory size, and splits further where a key is skewed;
    * with ``streaming_state`` (a streaming job's session), two state
      partitions per core and the RocksDB state store (state off the JVM
      heap) with changelog checkpointing; the state partition count is fixed
      at a query's first start.
    """
    slots = executors * cores_per_executor
    shuffle_parts = max(3 * slots, int(input_bytes * shuffle_ratio // target_partition_bytes))
    conf = {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if streaming_state:
        # A streaming job's shuffle partitions are its state partitions: one
        # state store each, for the life of the checkpoint. They are sized by
        # the cluster (two per core), not by the total input volume, which
        # arrives over many micro-batches.
        conf["spark.sql.shuffle.partitions"] = str(2 * slots)
        conf.update({
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        })
    return conf
