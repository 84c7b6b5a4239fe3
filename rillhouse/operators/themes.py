"""Windowed theme aggregates: visitors and products."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions.scalar import micros, money, time_cell, time_text
from rillhouse.operators.logs import is_entry

VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]
VISITOR_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]

# Measures of the product theme.
PRODUCT_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
                  "good_comment_ct"]
PRODUCT_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
PRODUCT_ORDER_SETS = {
    "order_ct": "order_id",
    "paid_order_ct": "paid_order_id",
    "refund_order_ct": "refund_order_id",
}


def window_key(df: DataFrame, ts: str, width: timedelta) -> Column:
    """Tumbling window to group by: the window itself on streams, where the watermark closes it,
    and just its start in microseconds on batches, where a plain number is a cheaper key."""
    return F.window(ts, span_text(width)) if df.isStreaming else time_cell(ts, width)


def window_bounds(key: str, width: timedelta, streaming: bool) -> list[Column]:
    """``stt`` and ``edt`` of a window key as text."""
    if streaming:
        start, end = F.col(f"{key}.start"), F.col(f"{key}.end")
    else:
        start = F.timestamp_micros(key)
        end = F.timestamp_micros(F.col(key) + F.lit(micros(width)))
    return [time_text(start).alias("stt"), time_text(end).alias("edt")]


def span_text(width: timedelta) -> str:
    return f"{width // timedelta(microseconds=1)} microseconds"


def _visitor_rows(logs: DataFrame, **measures: Column) -> DataFrame:
    cols = [measures.get(m, F.lit(0)).cast("long").alias(m) for m in VISITOR_SUMS]
    return logs.select(*[F.col(f"common.{k}").alias(k) for k in VISITOR_KEYS], *cols, "ts")


def visitor_rows(
    unique_visits: DataFrame, jumps: DataFrame, pages: DataFrame
) -> DataFrame:
    """Three log streams in one shape: one row per record with 0/1 measures."""
    uv = _visitor_rows(unique_visits, uv_ct=F.lit(1))
    uj = _visitor_rows(jumps, uj_ct=F.lit(1))
    pv = _visitor_rows(
        pages,
        pv_ct=F.lit(1),
        sv_ct=is_entry().cast("long"),
        dur_sum=F.coalesce("page.during_time", F.lit(0)),
    )
    return uv.unionByName(uj).unionByName(pv)


def visitor_stats(
    rows: DataFrame,
    width: timedelta = timedelta(seconds=10),
    lateness: timedelta | None = timedelta(seconds=11),
) -> DataFrame:
    """Sums per window and visitor dimensions; ``ts`` is the earliest time in the group."""
    timed = rows.withColumn("event_ts", F.timestamp_millis("ts"))
    if timed.isStreaming and lateness is not None:
        timed = timed.withWatermark("event_ts", span_text(lateness))
    return (
        timed.groupBy(window_key(timed, "event_ts", width).alias("w"), *VISITOR_KEYS)
        .agg(*[F.sum(m).alias(m) for m in VISITOR_SUMS], F.min("ts").alias("ts"))
        .select(
            *window_bounds("w", width, timed.isStreaming),
            *VISITOR_KEYS,
            *VISITOR_SUMS,
            "ts",
        )
    )


def product_rows(df: DataFrame, event_ts: str, **measures: Column) -> DataFrame:
    """Bring one product source to the common shape; measures not given are zero or null.

    Where a row has several order ids they must name the same order.
    """
    return df.select(
        F.col("sku_id").cast("long").alias("sku_id"),
        *[measures.get(c, F.lit(0)).cast("long").alias(c) for c in PRODUCT_COUNTS],
        *[money(measures.get(a, F.lit(0))).alias(a) for a in PRODUCT_AMOUNTS],
        *[
            measures.get(i, F.lit(None)).cast("long").alias(i)
            for i in PRODUCT_ORDER_SETS.values()
        ],
        F.col(event_ts).alias("event_ts"),
    )


def product_stats(
    rows: DataFrame,
    width: timedelta = timedelta(seconds=10),
    lateness: timedelta | None = timedelta(seconds=11),
) -> DataFrame:
    """Product theme per window and SKU with exact distinct order counts.

    Distinct ids are counted by two groupings instead of collecting id sets: first per order, where
    a flag says whether the order was placed, paid or refunded, then per SKU, where flags and
    amounts are summed. No set grows with the traffic of a hot SKU, and rows are not multiplied as
    they are for several distinct counts at once.
    """
    streaming = rows.isStreaming
    timed = rows.withWatermark("event_ts", span_text(lateness)) if streaming and lateness else rows
    ids = F.coalesce(*[F.col(i) for i in PRODUCT_ORDER_SETS.values()])
    per_order = timed.groupBy(
        window_key(timed, "event_ts", width).alias("w"), "sku_id", ids.alias("__order")
    ).agg(
        *[F.sum(m).alias(m) for m in [*PRODUCT_COUNTS, *PRODUCT_AMOUNTS]],
        *[
            F.max(F.col(i).isNotNull().cast("long")).alias(n)
            for n, i in PRODUCT_ORDER_SETS.items()
        ],
        F.min(F.unix_millis("event_ts")).alias("ts"),
    )
    window = F.window("w", span_text(width)) if streaming else F.col("w")
    return (
        per_order.groupBy(window.alias("w"), "sku_id")
        .agg(
            *[F.sum(m).alias(m) for m in PRODUCT_COUNTS],
            *[F.sum(m).cast("double").alias(m) for m in PRODUCT_AMOUNTS],
            *[F.sum(n).alias(n) for n in PRODUCT_ORDER_SETS],
            F.min("ts").alias("ts"),
        )
        .select(
            *window_bounds("w", width, streaming),
            "sku_id",
            *PRODUCT_COUNTS,
            *PRODUCT_AMOUNTS,
            *PRODUCT_ORDER_SETS,
            "ts",
        )
    )
