"""Wide order and payment records: interval join, merge, dimension attributes."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.scalar import age, event_time, parse_time
from rillhouse.operators.joins import interval_join, lookup_enrich, within

# Join intervals of the two wide records (both ends exclusive).
ORDER_LOWER, ORDER_UPPER = timedelta(seconds=-5), timedelta(seconds=5)
PAYMENT_LOWER, PAYMENT_UPPER = timedelta(minutes=-15), timedelta(seconds=100)


def prepare_orders(orders: DataFrame) -> DataFrame:
    """Event time, date and hour of order or detail records from their text time."""
    at = parse_time("create_time")
    out = orders.withColumn("event_ts", at).withColumn("create_ts", F.unix_millis(at))
    if "create_hour" in orders.columns:
        # The text has a fixed form, so its parts need no formatting of the time.
        text = F.when(at.isNotNull(), F.col("create_time"))
        out = out.withColumn("create_date", F.substring(text, 1, 10)).withColumn(
            "create_hour", F.substring(text, 12, 2)
        )
    return out


def with_fallback_time(df: DataFrame, record_ts: str) -> DataFrame:
    """Event time from the record, or from the source where the text does not parse."""
    return df.withColumn("event_ts", event_time("create_time", record_ts))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def merge_order_detail(
    info: DataFrame,
    detail: DataFrame,
    lower: timedelta = ORDER_LOWER,
    upper: timedelta = ORDER_UPPER,
) -> DataFrame:
    """Order joined to its details in time; on shared names the detail's value counts.

    Both inputs carry ``event_ts``. The result has the fields of the wide record and the later of
    the two event times.
    """
    pairs = interval_join(
        _prefixed(info, "i_"),
        _prefixed(detail, "d_"),
        [("i_id", "d_order_id")],
        "i_event_ts",
        "d_event_ts",
        lower,
        upper,
    )
    renamed = {"order_id": "i_id", "detail_id": "d_id"}
    return _pick(pairs, schemas.ORDER_WIDE, renamed, info, "i_", detail, "d_")


def merge_payment_order(
    payment: DataFrame,
    wide: DataFrame,
    lower: timedelta = PAYMENT_LOWER,
    upper: timedelta = PAYMENT_UPPER,
) -> DataFrame:
    """Payment joined to wide orders in time; on shared names the wide order's value counts."""
    pairs = interval_join(
        _prefixed(payment, "p_"),
        _prefixed(wide, "w_"),
        [("p_order_id", "w_order_id")],
        "p_event_ts",
        "w_event_ts",
        lower,
        upper,
    )
    renamed = {
        "payment_id": "p_id",
        "payment_create_time": "p_create_time",
        "order_create_time": "w_create_time",
    }
    return _pick(pairs, schemas.PAYMENT_WIDE, renamed, payment, "p_", wide, "w_")


def _pick(pairs, target, renamed, first, first_prefix, second, second_prefix) -> DataFrame:
    first_names, second_names = set(first.columns), set(second.columns)
    out = []
    for field in target.fields:
        name = field.name
        if name in renamed:
            col = F.col(renamed[name])
        elif name in second_names:
            col = F.col(second_prefix + name)
        elif name in first_names:
            col = F.col(first_prefix + name)
        else:
            col = F.lit(None)
        out.append(col.cast(field.dataType).alias(name))
    later = F.greatest(f"{first_prefix}event_ts", f"{second_prefix}event_ts")
    return pairs.select(*out, later.alias("event_ts"))


def product_dimension(dims: Mapping[str, DataFrame]) -> DataFrame:
    """SKU rows completed by their SPU, trademark and category names.

    Joining these on the dimension side costs three joins of small tables; the facts then need one
    lookup where a chain would need four. The result is as long as the SKU table.
    """
    sku = dims["DIM_SKU_INFO"]
    named = lookup_enrich(sku, dims["DIM_SPU_INFO"], "SPU_ID", "ID", {"SPU_NAME": "SPU_NAME"})
    named = lookup_enrich(
        named, dims["DIM_BASE_TRADEMARK"], "TM_ID", "ID", {"TM_NAME": "TM_NAME"}
    )
    return lookup_enrich(
        named, dims["DIM_BASE_CATEGORY3"], "CATEGORY3_ID", "ID", {"CATEGORY3_NAME": "NAME"}
    )


def enrich_order_wide(
    wide: DataFrame, dims: Mapping[str, DataFrame], as_of: str | Column
) -> DataFrame:
    """All dimension attributes of the wide order; a lookup miss leaves nulls."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    out = lookup_enrich(
        wide,
        dims["DIM_USER_INFO"],
        "user_id",
        "ID",
        {"user_gender": "GENDER", "user_age": age("BIRTHDAY", day)},
    )
    out = lookup_enrich(
        out,
        dims["DIM_BASE_PROVINCE"],
        "province_id",
        "ID",
        {
            "province_name": "NAME",
            "province_area_code": "AREA_CODE",
            "province_iso_code": "ISO_CODE",
            "province_3166_2_code": "ISO_3166_2",
        },
    )
    products = product_dimension(dims)
    out = lookup_enrich(
        out,
        products,
        "sku_id",
        "ID",
        {
            "sku_name": "SKU_NAME",
            "spu_id": F.col("SPU_ID").cast("long"),
            "tm_id": F.col("TM_ID").cast("long"),
            "category3_id": F.col("CATEGORY3_ID").cast("long"),
            "spu_name": "SPU_NAME",
            "tm_name": "TM_NAME",
            "category3_name": "CATEGORY3_NAME",
        },
        # The planner overestimates a joined table, so what would be sent is measured here.
        fits=within(products),
    )
    return out.select(*wide.columns)
