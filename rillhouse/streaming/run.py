"""Starting streams: checkpoints, triggers, and draining a bounded input."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillhouse.session import scratch

# Interval between micro-batches of the running jobs.
TRIGGER = "5 seconds"


def start(writer: DataStreamWriter, name: str, once: bool = False) -> StreamingQuery:
    """Start a job that goes on until stopped, or until its input is used up."""
    writer = writer.queryName(name)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=TRIGGER).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded job; its failure is raised here."""
    query.awaitTermination()


def for_each_batch(
    df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(work)
    )


def adaptive(batch: DataFrame) -> SparkSession:
    """The session of a micro-batch whose stream has no state in the engine: its plans may adapt, as
    no number of partitions is frozen."""
    session = batch.sparkSession
    session.conf.set("spark.sql.adaptive.enabled", "true")
    return session


def drain(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream over its present input and give what it wrote.

    ``spark`` reads the result; the stream may belong to another session of the application.
    """
    out = scratch(spark, label)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/state")
    )
    finish(start(writer, label, once=True))
    return spark.read.schema(df.schema).parquet(f"{out}/data")


def drain_paced(
    spark: SparkSession, df: DataFrame, label: str, stop_after: int | None = None
) -> DataFrame:
    """The same for sources that bound a micro-batch: batch after batch until nothing is left.

    With ``stop_after`` the stream is stopped once so many batches are done and started again from
    its checkpoint.
    """
    out = scratch(spark, label)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/state")
        .queryName(label)
    )
    run_paced(writer, stop_after)
    return spark.read.schema(df.schema).parquet(f"{out}/data")


def run_paced(writer: DataStreamWriter, stop_after: int | None = None) -> None:
    """Start a stream and let it go on until nothing is left, once more if it is stopped between."""
    if stop_after is not None:
        stopped(writer.start(), stop_after)
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def stopped(query: StreamingQuery, batches: int) -> None:
    """Stop a stream after some batches, or when it has nothing left to do."""
    while query.isActive:
        done = query.lastProgress
        idle = not query.status["isDataAvailable"] and not query.status["isTriggerActive"]
        if done is not None and (done.batchId + 1 >= batches or idle):
            break
        time.sleep(0.05)
    query.stop()


def drain_updates(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The same for an update-mode stream; adds the number of the batch a row came from."""
    out = scratch(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

    finish(
        start(for_each_batch(df, write, f"{out}/state", mode="update"), label, once=True)
    )
    return spark.read.schema(df.schema.add("batch", "long")).parquet(f"{out}/data")
