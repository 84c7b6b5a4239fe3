"""Lookups that read only the part of a dimension that a batch of facts asks for.

A dimension lies in folders by bucket of its key, and in the order of the key within a file. The keys
of a batch set bits of a fixed-size filter, built by native aggregates. The bits tell which buckets
are read at all; of their rows, only those whose key's bit is set reach the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.operators.joins import lookup_enrich
from rillhouse.session import exists

#: The filter's bits; it has 32 KB, whatever the batch holds.
SLOTS = 1 << 18
#: Bits of one native bitmap (a fixed value of the aggregate that builds them).
_MAP = 32_768
_BUCKET = "bucket"


def slot(key: str | Column) -> Column:
    """The place of a key in the filter; keys are compared as text, so their types may differ."""
    col = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(col.cast("string")), F.lit(SLOTS))


def write_keyed(rows: DataFrame, path: str, key: str, buckets: int = 256) -> None:
    """Write a dimension by buckets of its key. ``buckets`` divides the filter's bits."""
    if SLOTS % buckets:
        raise ValueError(f"{buckets} does not divide {SLOTS}")
    _write(rows.withColumn(_BUCKET, _bucket(key, buckets)), path, key, "errorifexists")


def _bucket(key: str, buckets: int) -> Column:
    return F.floor(slot(key) / (SLOTS // buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, mode: str) -> None:
    (
        rows.repartition(_BUCKET)
        .sortWithinPartitions(_BUCKET, key)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_BUCKET)
        .parquet(path)
    )


def update_keyed(
    spark: SparkSession, path: str, changes: DataFrame, key: str, buckets: int = 256
) -> None:
    """Replace or add the rows of ``changes``, one a key; only the buckets they lie in are rewritten.

    There is one writer at a time. A bucket is replaced as a whole when the new one is written, and
    the same changes may come again.
    """
    if not exists(spark, path):
        write_keyed(changes, path, key, buckets)
        return
    fresh = changes.withColumn(_BUCKET, _bucket(key, buckets)).persist()
    try:
        old = pruned(spark, path, fresh.schema, touched(filter_bits(fresh, key), buckets))
        kept = old.join(fresh.select(key), key, "left_anti").select(*fresh.columns)
        # with no rows of a touched bucket left there are at least its changes
        _write(kept.unionByName(fresh), path, key, "overwrite")
    finally:
        fresh.unpersist()


def filter_bits(rows: DataFrame, key: str | Column) -> bytes:
    """The filter of some rows' keys, from at most eight native bitmaps."""
    maps = (
        rows.select(slot(key).alias("s"))
        .where("s is not null")
        .groupBy(F.floor(F.col("s") / _MAP).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg((F.col("s") % _MAP).cast("long")).alias("bits"))
    )
    whole = bytearray(SLOTS // 8)
    for part, bits in maps.collect():
        whole[part * _MAP // 8 : (part + 1) * _MAP // 8] = bits
    return bytes(whole)


def touched(bits: bytes, buckets: int) -> list[int]:
    """The buckets that hold a slot whose bit is set."""
    width = SLOTS // buckets
    whole = int.from_bytes(bits, "little")
    mask = (1 << width) - 1
    return [b for b in range(buckets) if whole >> b * width & mask]


def has_bit(bits: bytes, at: Column) -> Column:
    byte = F.substring(F.lit(bytearray(bits)), F.floor(at / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (at % 8).cast("int")) == 1


def pruned(spark: SparkSession, path: str, schema, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets; the others' files are not opened."""
    return spark.read.schema(schema).parquet(path).where(F.col(_BUCKET).isin(list(buckets)))


def asked_for(
    spark: SparkSession, path: str, schema, facts: DataFrame, key: str | Column, dim_key: str,
    buckets: int = 256,
) -> DataFrame:
    """The rows of a keyed dimension that the facts can meet, and few others.

    ``schema`` are the dimension's columns; ``facts`` are read once for the filter, so hand in what
    is stored or persisted.
    """
    bits = filter_bits(facts, key)
    whole = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
    rows = pruned(spark, path, whole, touched(bits, buckets))
    return rows.where(has_bit(bits, slot(dim_key))).drop(_BUCKET)


def lookup_keyed(
    facts: DataFrame,
    path: str,
    schema,
    key: str | Column,
    dim_key: str,
    columns: Mapping[str, str | Column],
    how: str = "left",
    buckets: int = 256,
) -> DataFrame:
    """``lookup_enrich`` against the part of a keyed dimension that the facts ask for."""
    asked = asked_for(facts.sparkSession, path, schema, facts, key, dim_key, buckets)
    return lookup_enrich(facts, asked, key, dim_key, columns, how)
