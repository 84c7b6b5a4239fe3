"""Middle layer: daily first visits, bounces, wide orders and payments (batch forms)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.operators.logs import is_entry
from rillhouse.operators.ordered import entry_pattern, first_per_day
from rillhouse.operators.wide import (
    enrich_order_wide,
    merge_order_detail,
    merge_payment_order,
    prepare_orders,
    with_fallback_time,
)

TOPIC_UNIQUE_VISIT = "dwm_unique_visit"
TOPIC_USER_JUMP = "dwm_user_jump_detail"
TOPIC_ORDER_WIDE = "dwm_order_wide"
TOPIC_PAYMENT_WIDE = "dwm_payment_wide"

JUMP_HORIZON = timedelta(seconds=10)


def unique_visit(pages: DataFrame, tie: str) -> DataFrame:
    """First entry page of each device per day. ``pages`` carries ``event_ts``."""
    rows = pages.where(is_entry()).withColumn("mid", F.col("common.mid"))
    return first_per_day(rows, "mid", "event_ts", tie)


def user_jump(pages: DataFrame, tie: str, horizon: timedelta = JUMP_HORIZON) -> DataFrame:
    """Entry pages the visitor left without going on. ``pages`` carries ``event_ts``."""
    rows = pages.withColumn("mid", F.col("common.mid"))
    return entry_pattern(rows, "mid", "event_ts", tie, is_entry(), horizon)


def order_wide(
    info: DataFrame,
    detail: DataFrame,
    dims: Mapping[str, DataFrame],
    as_of: str,
    **bounds: timedelta,
) -> DataFrame:
    merged = merge_order_detail(prepare_orders(info), prepare_orders(detail), **bounds)
    return enrich_order_wide(merged, dims, as_of)


def payment_wide(payment: DataFrame, wide: DataFrame, **bounds: timedelta) -> DataFrame:
    """``payment`` carries ``record_ts``, the source's time, used where its own does not parse."""
    return merge_payment_order(with_fallback_time(payment, "record_ts"), wide, **bounds)
