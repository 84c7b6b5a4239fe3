"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", memory: str = "8g", app: str = "rillhouse") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores if cores != "*" else "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent (tests) a local folder is made once per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = os.path.join(
        tempfile.gettempdir(), f"rillhouse-{spark.sparkContext.applicationId}"
    )
    os.makedirs(made, exist_ok=True)
    return made


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application with the settings that stateful streams need.

    The number of state partitions is frozen into a stream's checkpoint and is not adapted at
    run time. Name it for a job that is to last, in particular where executors come and go; without
    it, it follows the cores that the application has now.
    """
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set(
        "spark.sql.shuffle.partitions",
        str(state_partitions or max(1, spark.sparkContext.defaultParallelism)),
    )
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    session.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    # sessions are merged per task before they are shuffled
    session.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    return session


def is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getFileStatus(where).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file that marks something as done."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(where, True).close()


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stream_of(batch_rows) -> str | None:
    """The id of the stream that a micro-batch belongs to: kept by its checkpoint over restarts,
    and another for every new checkpoint. None outside a stream."""
    return batch_rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_of(batch_rows) -> str:
    return stream_of(batch_rows) or "batch"
