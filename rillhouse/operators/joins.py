"""Interval joins, dimension lookups and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.functions.scalar import micros, time_cell

_CELL = "__cell"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    lower: timedelta,
    upper: timedelta,
    lower_exclusive: bool = True,
    upper_exclusive: bool = True,
    cell: timedelta | None = None,
) -> DataFrame:
    """Inner equi-join whose right time lies within (left + lower, left + upper).

    Works on batches and on two watermarked streams. Column names of both sides must differ.

    The time line is cut into cells and the cell becomes part of the equi-key: a right row lives in
    one cell, a left row is offered to the one or two cells its interval touches. A key that holds
    a third of the rows is thereby spread over its history, and the pairs compared stay close to
    the pairs that match, where an equi-join on the key alone would compare them all. Each pair
    meets in exactly one cell, so no pair is lost or doubled.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if upper < lower:
        raise ValueError("upper bound below lower bound")
    cell = cell or max(4 * (upper - lower), timedelta(seconds=1))

    low = F.col(left_ts) + F.lit(lower)
    high = F.col(left_ts) + F.lit(upper)
    offered = left.withColumn(
        _CELL,
        F.explode(F.sequence(time_cell(low, cell), time_cell(high, cell), F.lit(micros(cell)))),
    )
    placed = right.withColumn(_CELL + "_r", time_cell(right_ts, cell))

    condition = F.col(_CELL) == F.col(_CELL + "_r")
    for lcol, rcol in on:
        condition &= F.col(lcol) == F.col(rcol)
    at = F.col(right_ts)
    condition &= (at > low) if lower_exclusive else (at >= low)
    condition &= (at < high) if upper_exclusive else (at <= high)
    return offered.join(placed, condition, "inner").drop(_CELL, _CELL + "_r")


def lookup_enrich(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Column,
    dim_key: str,
    columns: Mapping[str, str | Column],
    how: str = "left",
    fits: bool = False,
) -> DataFrame:
    """Add dimension attributes to every fact row; rows without a partner get nulls.

    ``columns`` maps output names to dimension columns or expressions over them. An output name the
    fact already has is replaced. Without a hint the planner broadcasts the pruned dimension when
    its measured size is below the session's threshold and otherwise joins by shuffle, where
    adaptive execution splits the partitions of a hot key. ``fits`` says that the caller has
    measured the dimension (``within``) and asks for the broadcast.
    """
    fact_key = F.col(key) if isinstance(key, str) else key
    key_type = fact.select(fact_key).schema[0].dataType
    dim_type = dim.schema[dim_key].dataType
    match = F.col(dim_key)
    if isinstance(key_type, T.IntegralType) and isinstance(dim_type, T.StringType):
        # Stored keys are text. The dimension side is turned into numbers once, so that the facts
        # are hashed by number; a text that is not the number's own notation matches nothing.
        number = match.try_cast("long")
        match = F.when(number.cast("string") == match, number)
    elif key_type != dim_type and not (
        isinstance(key_type, T.IntegralType) and isinstance(dim_type, T.IntegralType)
    ):
        match, fact_key = match.cast("string"), fact_key.cast("string")
    side = dim.select(
        match.alias("__k"),
        *[
            (F.col(expr) if isinstance(expr, str) else expr).alias(f"__v_{name}")
            for name, expr in columns.items()
        ],
    )
    joined = fact.join(F.broadcast(side) if fits else side, fact_key == F.col("__k"), how)
    kept = [F.col(f"`{c}`") for c in fact.columns if c not in columns]
    added = [F.col(f"__v_{name}").alias(name) for name in columns]
    return joined.select(*kept, *added)


#: A side may be sent to every executor up to this size.
BROADCAST_BYTES = 8 << 20
_LEAST_ROW = 32


def within(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table, written as JSON, has at most ``max_bytes``; stops reading beyond them."""
    most = max_bytes // _LEAST_ROW
    sizes = df.limit(most + 1).select(
        F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("b")
    )
    n, size = sizes.agg(F.count(F.lit(1)), F.sum("b")).first()
    return n <= most and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a side for broadcast only after measuring its bytes; a larger one gets no hint."""
    return F.broadcast(df) if within(df, max_bytes) else df
