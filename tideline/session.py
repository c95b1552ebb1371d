"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # a JSON object that repeats a key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    # required by transformWithState, and keeps large state off the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a micro-batch writes what it changed, which can be read back as a change feed
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no megabytes set aside per state partition
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, memory: str = "12g", app: str = "tideline") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
        shared = spark.sparkContext.getCheckpointDir()
    return shared


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
