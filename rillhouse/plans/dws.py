"""Theme layer: visitor and product statistics per window."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.operators.joins import lookup_enrich
from rillhouse.operators.shape import union_all
from rillhouse.operators.themes import product_stats, visitor_rows, visitor_stats

WINDOW = timedelta(seconds=10)
LATENESS = timedelta(seconds=11)


def visitor(
    unique_visits: DataFrame, jumps: DataFrame, pages: DataFrame, width: timedelta = WINDOW
) -> DataFrame:
    return visitor_stats(visitor_rows(unique_visits, jumps, pages), width, LATENESS)


def product(sources: Iterable[DataFrame], width: timedelta = WINDOW) -> DataFrame:
    return product_stats(union_all(sources), width, LATENESS)


def describe_products(stats: DataFrame, products: DataFrame) -> DataFrame:
    """Names and groups of each SKU; ``products`` is the completed product dimension."""
    named = lookup_enrich(
        stats,
        products,
        "sku_id",
        "ID",
        {
            "sku_name": "SKU_NAME",
            "spu_id": F.col("SPU_ID").cast("long"),
            "spu_name": "SPU_NAME",
            "tm_id": F.col("TM_ID").cast("long"),
            "tm_name": "TM_NAME",
            "category3_id": F.col("CATEGORY3_ID").cast("long"),
            "category3_name": "CATEGORY3_NAME",
        },
    )
    have = set(named.columns)
    return named.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.PRODUCT_STATS.fields
        ]
    )
