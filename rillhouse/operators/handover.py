"""From a table's snapshot to its change log, without a gap and without a repeat.

A table is read in chunks while it goes on changing. The log's position is noted before (``low``)
and after (``high``) a chunk is read, so what the chunk saw of a key lies somewhere between the two.
Where the log changes the key in between, the log is right and the snapshot's row is dropped; where
it does not, the row is the key's state at ``low``. The log goes on behind ``low`` of each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.operators.joins import broadcast_if_small
from rillhouse.session import scratch

READ = "read"


def read_chunks(
    spark: SparkSession,
    chunks: Iterable[int],
    read: Callable[[int], DataFrame],
    position: Callable[[], int],
) -> tuple[DataFrame, DataFrame]:
    """``(rows, marks)``: the rows of all chunks with their ``chunk``, and ``(chunk, low, high)``.

    ``read`` gives the rows of a chunk of the table, ``position`` the log's last position now. Each
    chunk is written before its ``high`` is noted. There is one mark a chunk, so their number is
    the reader's choice and not the data's.
    """
    path, marks = scratch(spark, "snapshot"), []
    schema = None
    for chunk in chunks:
        low = position()
        rows = read(chunk)
        rows.write.parquet(f"{path}/chunk={chunk}")
        marks.append((chunk, low, position()))
        schema = rows.schema
    if schema is None:
        raise ValueError("no chunks")
    schema = T.StructType([*schema.fields, T.StructField("chunk", T.IntegerType())])
    return spark.read.schema(schema).parquet(path), spark.createDataFrame(marks, "chunk int, low long, high long")


def reconciled(
    rows: DataFrame, marks: DataFrame, log: DataFrame, key: str, pos: str
) -> DataFrame:
    """The snapshot's rows that stand, with the position in ``pos`` and ``type`` read.

    ``log`` holds at least the changes between the marks, with ``key``, ``pos`` and ``chunk``. Only
    changes within a chunk's marks are shuffled, each key of them once.
    """
    side = marks.select(F.col("chunk").alias("__chunk"), "low", "high")
    inside = log.join(broadcast_if_small(side), F.col("chunk") == F.col("__chunk")).where(
        (F.col(pos) > F.col("low")) & (F.col(pos) <= F.col("high"))
    )
    changed = inside.select(F.col(key).alias("__key")).distinct()
    known = rows.join(broadcast_if_small(side), F.col("chunk") == F.col("__chunk"))
    kept = known.join(changed, F.col(key) == F.col("__key"), "left_anti")
    return kept.select(
        *[c for c in rows.columns if c != "chunk"], F.col("low").alias(pos), F.lit(READ).alias("type")
    )


def after_snapshot(log: DataFrame, marks: DataFrame, pos: str) -> DataFrame:
    """The changes of the log that the snapshot does not hold; on batches and streams.

    Changes of a chunk that was never read pass, as a snapshot without a chunk holds none of it.
    """
    side = marks.select(F.col("chunk").alias("__chunk"), "low")
    joined = log.join(broadcast_if_small(side), F.col("chunk") == F.col("__chunk"), "left")
    fresh = F.col("low").isNull() | (F.col(pos) > F.col("low"))
    return joined.where(fresh).select(*[c for c in log.columns if c != "chunk"])


def latest(records: DataFrame, key: str, pos: str) -> DataFrame:
    """The table that records of ``key``, ``pos``, ``type`` and cells give: each key's last one,
    keys that were deleted last left out. One candidate a task and key is shuffled."""
    rest = [c for c in records.columns if c not in (key, pos)]
    last = records.groupBy(key).agg(F.max_by(F.struct(*rest), pos).alias("__last"))
    return last.where("__last.type <> 'delete'").select(
        key, *[F.col(f"__last.{c}").alias(c) for c in rest if c != "type"]
    )
