"""Sinks: topics, dimension and OLAP tables, text files, console."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rillhouse.session import exists, stream_of, touch
from rillhouse.sources import committed
from rillhouse.sources.readers import Endpoint, counter

cloudpickle.register_pickle_by_value(committed)


def messages(df: DataFrame, topic: str) -> DataFrame:
    """Rows as JSON messages of one topic."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"),
    )


def routed_messages(routed: DataFrame, default_topic: str = "default") -> DataFrame:
    """Routed change records: the rule's table is the topic, the pruned cells the payload."""
    return routed.select(
        F.coalesce("sink_table", F.lit(default_topic)).alias("topic"),
        F.to_json("after").alias("value"),
    )


def write_topics(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(topic, value) rows to one folder per topic, in a single write."""
    rows.select("topic", "value").write.mode(mode).partitionBy("topic").text(path)


def topic_stream(
    rows: DataFrame, endpoint: Endpoint, checkpoint: str, topic: str | None = None
) -> DataStreamWriter:
    """Writer for (topic, value) rows, or for ``value`` rows of one fixed topic.

    Any number of jobs may write to one endpoint, also to one topic.
    """
    out = rows if topic is None else rows.select(F.lit(topic).alias("topic"), "value")
    writer = (
        out.select("topic", "value")
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if endpoint.kind == "kafka":
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", endpoint.at)
            .options(**endpoint.options)
        )
    if endpoint.kind == "files":
        return writer.foreachBatch(lambda batch, i: write_batch_topics(batch, endpoint, i))
    raise ValueError(f"no sink of kind: {endpoint.kind}")


def write_batch_topics(
    rows: DataFrame, endpoint: Endpoint, batch_id: int, run: str | None = None
) -> None:
    """One micro-batch of (topic, value) rows.

    Files of a topic lie below ``topic=<name>/run=<stream>/batch=<id>``, the layout that
    ``text_stream`` reads. ``run`` is the id of the stream, so jobs and fresh checkpoints do not
    meet. A batch that was written is marked; if it comes again it is left as it is, so readers
    never see it twice. One cut off before the mark replaces its own folders. Outside a stream
    ``run`` must be named: a write that named none would pass for the repeat of another.
    """
    if endpoint.kind == "kafka":
        (
            rows.select("topic", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", endpoint.at)
            .options(**endpoint.options)
            .save()
        )
        return
    spark, root, run = rows.sparkSession, endpoint.at.rstrip("/"), run or stream_of(rows)
    if run is None:
        raise ValueError("name the run of a write outside a stream")
    done = f"{root}/_done/run={run}/batch={batch_id}"
    if exists(spark, done):
        return
    (
        rows.select("topic", F.lit(run).alias("run"), F.lit(batch_id).alias("batch"), "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", "run", "batch")
        .text(root)
    )
    touch(spark, done)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Pipe-delimited text. One file means one task, so that is for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", "|").csv(path)


def bound_columns(columns: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    """Columns a table sink writes: declaration order without the excluded ones."""
    columns, exclude = list(columns), set(exclude)
    unknown = exclude - set(columns)
    if unknown:
        raise ValueError(f"not in the record: {sorted(unknown)}")
    return [c for c in columns if c not in exclude]


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    exclude: Iterable[str] = (),
    batch_size: int = 5,
    extra: Mapping[str, str] | None = None,
) -> None:
    """Append rows to a database table, fields marked transient left out.

    The default batch of five suits a trickle; raise it with the volume.
    """
    (
        df.select(*bound_columns(df.columns, exclude))
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .options(**(extra or {}))
        .save()
    )


def jdbc_stream(
    df: DataFrame, url: str, table: str, checkpoint: str, **options
) -> DataStreamWriter:
    """The same for a stream. A repeated micro-batch is appended again, so the target table
    should replace rows by key."""
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: write_jdbc(batch, url, table, **options)
    )


def buffered_stream(df: DataFrame, path: str, checkpoint: str, threshold: int) -> DataStreamWriter:
    """Files of at most ``threshold`` records each; what is not committed is replayed."""
    return (
        df.writeStream.format("json")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", threshold)
    )


def committed_stream(
    df: DataFrame, path: str, checkpoint: str, exclude: Iterable[str] = ()
) -> DataStreamWriter:
    """Batches that count as a whole and once, fields marked transient left out; read them with
    ``committed.read_committed``."""
    # a sink's name is looked up in the session that is active, which may be another
    for session in (df.sparkSession, SparkSession.getActiveSession() or df.sparkSession):
        session.dataSource.register(committed.CommittedBatches)
    bound_columns(df.columns, exclude)
    return (
        df.writeStream.format("committed_batches")
        .outputMode("append")
        .option("path", path)
        .option("transient", ",".join(exclude))
        .option("checkpointLocation", checkpoint)
    )


def buffered_exact(
    df: DataFrame,
    order: Sequence[str],
    path: str,
    held: str,
    checkpoint: str,
    threshold: int,
    ts: str | None = None,
    timeout: timedelta | None = None,
) -> DataStreamWriter:
    """JSON files of exactly ``threshold`` records, in the order of ``order`` within a batch.

    Records that do not fill a file wait below ``held``, fewer than ``threshold`` of them, and come
    first in the next batch. With ``ts`` and ``timeout`` they are written as a shorter file once the
    latest time is that much behind theirs. A batch that is repeated starts from the same held
    records and replaces its own files. ``flush_held`` writes what waits when a stream is over.
    """
    own = df.schema

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = _waiting(batch.sparkSession, held, batch_id - 1, own)
        rows = rows.withColumn("__new", F.lit(0)).unionByName(batch.withColumn("__new", F.lit(1)))
        rows = counter(rows, "__new", *order).persist()
        try:
            n = rows.count()
            full = n - n % threshold
            if ts is not None and timeout is not None and n:
                first = rows.where(F.col("value") >= full).agg(F.min(ts)).first()[0]
                last = rows.agg(F.max(ts)).first()[0]
                full = n if first is not None and last - first >= timeout else full
            _files(rows.where(F.col("value") < full), threshold, f"{path}/batch={batch_id}", own)
            rest = rows.where(F.col("value") >= full).select(*own.names)
            rest.write.mode("overwrite").parquet(f"{held}/{batch_id}")
        finally:
            rows.unpersist()

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(work)


def _waiting(spark: SparkSession, held: str, batch_id: int, schema) -> DataFrame:
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{held}/{batch_id}")


def _files(numbered: DataFrame, threshold: int, path: str, schema) -> None:
    file = F.floor(F.col("value") / threshold)
    (
        numbered.withColumn("file", file)
        .repartition("file")
        .sortWithinPartitions("file", "value")
        .select(*schema.names, "file")
        .write.mode("overwrite")
        .partitionBy("file")
        .json(path)
    )


def flush_held(spark: SparkSession, schema, path: str, held: str, batch_id: int) -> None:
    """Write the records that wait behind a batch as the last file."""
    rest = _waiting(spark, held, batch_id, schema)
    rest.coalesce(1).write.mode("overwrite").json(f"{path}/batch={batch_id}/file=last")


def console_stream(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    return df.writeStream.format("console").option("numRows", rows).option("truncate", False)
