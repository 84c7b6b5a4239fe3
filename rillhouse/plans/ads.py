"""Application layer: what is displayed, computed from theme tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.operators.summaries import cube, filter_aggregate, rollup, totals


def _visits() -> dict:
    return {m: F.col(m) for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")}


def visits_by_channel_and_area(stats: DataFrame) -> DataFrame:
    return rollup(stats, ["ch", "ar"], _visits())


def visits_cube(stats: DataFrame) -> DataFrame:
    return cube(stats, ["ch", "ar", "is_new"], _visits())


def visits_with_total(stats: DataFrame) -> DataFrame:
    return totals(stats, ["ch", "ar"], _visits())


def visits_of_new(stats: DataFrame) -> DataFrame:
    """Visits of new visitors per version and channel."""
    return filter_aggregate(stats, F.col("is_new") == "1", ["vc", "ch"], _visits())
