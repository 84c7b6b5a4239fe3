"""Sources: broker topics, folders of text lines, sockets, JDBC queries, counters.

Every text source gives a DataFrame with ``value``. Which system stands behind it is decided by a
small description (``Endpoint``), so a job runs unchanged on a broker and on files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas
from rillhouse.operators.shape import camel_columns
from rillhouse.session import scratch
from rillhouse.sources import positions

cloudpickle.register_pickle_by_value(positions)

# Most records one micro-batch takes from a broker; the rest follows in the next batches. Bounds
# what a stateful step can see of one key at a time.
MAX_OFFSETS_PER_TRIGGER = "10000000"


@dataclass(frozen=True)
class Endpoint:
    """Where text records come from or go to.

    ``kind`` is ``kafka``, ``files`` or ``socket``; ``at`` the bootstrap servers, the root folder
    or ``host:port``. Below a root folder each topic is a folder ``topic=<name>``.
    """

    kind: str
    at: str
    options: Mapping[str, str] = field(default_factory=dict)


def source_options(endpoint: Endpoint, *topics: str) -> tuple[str, dict[str, str]]:
    """Format name and options of the stream reader for some topics."""
    if endpoint.kind == "kafka":
        options = {
            "kafka.bootstrap.servers": endpoint.at,
            "subscribe": ",".join(topics),
            "startingOffsets": "earliest",
            "maxOffsetsPerTrigger": MAX_OFFSETS_PER_TRIGGER,
        }
    elif endpoint.kind == "files":
        names = topics[0] if len(topics) == 1 else "{" + ",".join(topics) + "}"
        # below a topic, folders of runs and batches are only places, not columns
        path = f"{endpoint.at.rstrip('/')}/topic={names}"
        options = {"path": path, "recursiveFileLookup": "true"}
    elif endpoint.kind == "socket":
        host, port = endpoint.at.rsplit(":", 1)
        options = {"host": host, "port": port}
    else:
        raise ValueError(f"unknown source kind: {endpoint.kind}")
    options.update(endpoint.options)
    return ("text" if endpoint.kind == "files" else endpoint.kind), options


def text_stream(spark: SparkSession, endpoint: Endpoint, *topics: str) -> DataFrame:
    """A stream of text records with ``topic``, ``record_ts`` and ``offset``.

    From a broker these are the record's own. A record from a file has the time at which its file
    was finished, which a replay meets again, and as ``offset`` a hash of file and text: a fixed
    place to break ties by, the same for equal lines of one file.
    """
    fmt, options = source_options(endpoint, *topics)
    raw = spark.readStream.format(fmt).options(**options).load()
    return _positioned(raw, endpoint)


def text_batch(spark: SparkSession, endpoint: Endpoint, *topics: str) -> DataFrame:
    """The records that topics hold now, with the same columns."""
    fmt, options = source_options(endpoint, *topics)
    return _positioned(spark.read.format(fmt).options(**options).load(), endpoint)


def _positioned(raw: DataFrame, endpoint: Endpoint) -> DataFrame:
    if endpoint.kind == "kafka":
        return raw.select(
            F.col("topic"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("record_ts"),
            F.col("partition"),
            F.col("offset"),
        )
    if endpoint.kind == "files":
        path = F.col("_metadata.file_path")
        return raw.select(
            F.regexp_extract(path, "/topic=([^/]+)/", 1).alias("topic"),
            "value",
            F.col("_metadata.file_modification_time").alias("record_ts"),
            F.xxhash64(path, "value").alias("offset"),
        )
    return raw.select("value")


def jdbc_options(
    url: str,
    query: str,
    partition: tuple[str, int, int, int] | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a query; ``partition`` is (column, lower, upper, number of parts).

    Without ``partition`` a database is read by one task, which only suits small tables. The
    bounds only place the cuts; rows outside them are read as well.
    """
    options = {"url": url, **(extra or {})}
    if partition is None:
        return {**options, "query": query}
    column, low, high, parts = partition
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    camel: bool = False,
    partition: tuple[str, int, int, int] | None = None,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a query, with ``camelCase`` column names if asked for."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, query, partition, extra)).load()
    return camel_columns(df) if camel else df


def snapshot_changes(table_rows: DataFrame, server: str, database: str, table: str) -> DataFrame:
    """A table's present rows as raw change records of the kind "read"."""
    image = F.map_from_arrays(
        F.array(*[F.lit(c) for c in table_rows.columns]),
        F.array(*[F.col(c).cast("string") for c in table_rows.columns]),
    )
    return table_rows.select(
        F.lit(f"{server}.{database}.{table}").alias("topic"),
        F.to_json(F.struct(image.alias("after"), F.lit("r").alias("op"))).alias("value"),
    )


def counter(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` numbered from 0 in the order of ``by``, as ``value``; equal rows in any order.

    Rows are dealt by ranges and numbered within them; the numbers of the ranges before, one for
    each task, are added afterwards. No task sees more than its range.
    """
    path = scratch(rows.sparkSession, "numbered")
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # an id is the task's number and, below it, the row's number within the task
    placed.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("__id", T.LongType())])
    back = rows.sparkSession.read.schema(schema).parquet(path)
    task = F.shiftright("__id", 33)
    sizes = back.groupBy(task.alias("__task")).count()
    before = W.orderBy("__task").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select("__task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__n"))
    numbered = back.withColumn("__task", task).join(F.broadcast(shifts), "__task")
    number = F.col("__n") + F.col("__id") - F.shiftleft("__task", 33)
    return numbered.select(number.alias("value"), *rows.columns)


def counter_stream(
    spark: SparkSession, path: str, per_batch: int, number: str = "value"
) -> DataFrame:
    """The rows of a Parquet table as a stream, numbered from 0 as ``number``, ``per_batch`` at a
    time; the position is kept in the stream's checkpoint."""
    spark.dataSource.register(positions.NumberedRows)
    reader = spark.readStream.format("numbered_rows").option("path", path)
    return reader.option("rowsPerBatch", per_batch).option("number", number).load()


def topic_stream(
    spark: SparkSession, endpoint: Endpoint, *topics: str, per_batch: int | None = None
) -> DataFrame:
    """Topic folders as a stream with the position of every record.

    ``offset`` grows along a queue, which is one ``run`` of one ``topic``: files in their order, lines
    in theirs. ``per_batch`` bounds the bytes of a micro-batch, so it must not be run with a
    trigger that takes all at once; ``run.drain_paced`` goes on until nothing is left.
    """
    spark.dataSource.register(positions.TopicFiles)
    reader = spark.readStream.format("topic_files").option("path", endpoint.at)
    if per_batch is not None:
        reader = reader.option("bytesPerBatch", per_batch)
    return reader.option("topics", ",".join(topics)).options(**endpoint.options).load()


def order_table(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON order lines with the columns of the order table.

    ``promiseTime`` is declared by the table but not by the JSON, so it is null.
    """
    record = F.from_json(value, schemas.ORDER_TABLE_JSON)
    return lines.select(record.alias("__r")).select(
        F.col("__r.transactionId").alias("transactionId"),
        F.col("__r.orderTime").alias("orderTime"),
        F.lit(None).cast("timestamp").alias("promiseTime"),
    )


def register_order_table(lines: DataFrame, name: str = "order_table") -> None:
    order_table(lines).createOrReplaceTempView(name)
