"""Detail layer: behaviour logs split by kind, business changes routed by rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.operators.cdc import (
    current_rules,
    drop_deletes,
    normalize_cdc,
    route_by_rules,
)
from rillhouse.operators.logs import parse_all, route_log
from rillhouse.operators.ordered import correct_new_flag


def parse_stage(spark: SparkSession, lines: DataFrame, path: str) -> DataFrame:
    """Raw lines parsed once and kept as a table, which later steps read by column.

    Written to shared storage rather than cached: it outlives the executors that wrote it.
    """
    parsed = parse_all(lines).select(
        "*", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new")
    )
    parsed.write.mode("overwrite").parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def base_log(parsed: DataFrame, tie: str) -> DataFrame:
    """Parsed lines to (topic, value) messages with corrected new-visitor flags, dirty lines
    included. ``tie`` is a record's position in its source."""
    fixed = correct_new_flag(parsed, "mid", "is_new", "ts", tie)
    common = F.col("common").withField("is_new", F.col("is_new"))
    return route_log(fixed.withColumn("common", common))


def base_db(changes: DataFrame, rule_feed: DataFrame, seq: str = "seq") -> DataFrame:
    """Raw change records without deletes, routed by the rules in force."""
    return route_by_rules(drop_deletes(normalize_cdc(changes)), current_rules(rule_feed, seq))
