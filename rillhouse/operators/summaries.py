"""Application layer: rollup, cube, totals and filtered aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finest(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums at the finest grain.

    Grouping sets copy each input row once per set. Run over the raw facts that multiplies their
    number before anything is aggregated; run over the finest grain it only touches groups.
    """
    return df.groupBy(*dims).agg(*[F.sum(v).alias(n) for n, v in sums.items()])


def _again(grouped, sums: Mapping[str, Column]) -> DataFrame:
    return grouped.agg(F.grouping_id().alias("gid"), *[F.sum(n).alias(n) for n in sums])


def rollup(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums per prefix of ``dims``; ``gid`` tells a rolled-up dimension from a null value."""
    return _again(finest(df, dims, sums).rollup(*dims), sums)


def cube(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums per subset of ``dims``."""
    return _again(finest(df, dims, sums).cube(*dims), sums)


def totals(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums per group plus the grand total."""
    whole = [F.col(d) for d in dims]
    return _again(finest(df, dims, sums).groupingSets([whole, []], *dims), sums)


def filter_aggregate(
    df: DataFrame, where: Column, dims: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    return finest(df.where(where), dims, sums)


def per_partition_counts(df: DataFrame, *by: str) -> DataFrame:
    """Records per physical partition, and per ``by`` in it."""
    part = F.spark_partition_id().alias("part")
    return df.groupBy(part, *by).agg(F.count(F.lit(1)).alias("n"))


def running_key_count(df: DataFrame, key: str) -> DataFrame:
    """Count per key; on a stream in update mode, the running count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
