"""Session set-up and the shared folder for checkpoints and state tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "eddyline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators expect.

    ``master`` and ``shuffle_partitions`` are for local runs.  On a cluster leave both unset:
    spark-submit names the master, and AQE coalesces from a high initial partition number.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and state tables: the one the cluster names.

    ``spark.checkpoint.dir`` comes first, then a checkpoint folder already set on the context.
    Where neither is set, a local session gets a folder of its own; on a cluster that would be one
    machine's disk, so it is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="eddyline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for one run's tables or stream checkpoint."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
