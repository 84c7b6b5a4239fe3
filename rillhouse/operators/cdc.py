"""Change-capture records: envelope normalisation, delete filter, rule routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas
from rillhouse.operators.joins import BROADCAST_BYTES, within

# Operation names, fixed by the change-capture format: short code or long name -> record type.
OPERATION_TYPES = {
    "c": "insert",
    "create": "insert",
    "u": "update",
    "update": "update",
    "d": "delete",
    "delete": "delete",
    "r": "read",
    "read": "read",
}

# Sink types of the routing rules.
SINK_KAFKA = "kafka"
SINK_DIM = "hbase"
SINK_OLAP = "clickhouse"
UNMATCHED = "unmatched"
# Parts that the records of one (table, type) are spread over where rules are joined by shuffle.
RULE_SALTS = 32


def normalize_cdc(
    df: DataFrame, topic: str = "topic", value: str = "value", unreadable: str | None = None
) -> DataFrame:
    """``server.database.table`` topic plus change JSON to the normalised envelope.

    Other columns of the input (offsets, record times) are kept in front. ``unreadable`` names a
    further column: the text of a record that the parser gave nothing for, null for all others.
    """
    record = F.from_json(F.col(value), schemas.CDC_VALUE)
    part = F.split(F.col(topic), r"\.")
    op = F.lower(F.col("__r.op"))
    kind = op
    for name, target in OPERATION_TYPES.items():
        kind = F.when(op == name, F.lit(target)).otherwise(kind)
    empty = F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    rest = [c for c in df.columns if c not in (topic, value)]
    # A generator of one row keeps later filters above it, so each text is parsed once.
    text = [] if unreadable is None else [value]
    parsed = df.select(*rest, topic, *text, F.explode(F.array(record)).alias("__r"))
    nothing = F.coalesce(F.col("__r.op"), F.col("__r.before").cast("string"),
                         F.col("__r.after").cast("string")).isNull()
    return parsed.select(
        *rest,
        F.get(part, F.lit(1)).alias("database"),
        F.get(part, F.lit(2)).alias("table"),
        F.coalesce(F.col("__r.before"), empty).alias("before"),
        F.coalesce(F.col("__r.after"), empty).alias("after"),
        kind.alias("type"),
        *[F.when(nothing, F.col(value)).alias(unreadable) for _ in text],
    )


def drop_deletes(df: DataFrame) -> DataFrame:
    """Everything but deletes; a record without a type is kept."""
    return df.where(F.coalesce(F.col("type"), F.lit("")) != "delete")


def current_rules(feed: DataFrame, seq: str) -> DataFrame:
    """Rules in force, from a normalised change feed of the rule table.

    The last change of a (sourceTable, operateType) key wins; a delete removes the rule.
    """
    names = schemas.TABLE_PROCESS.fieldNames()
    gone = F.col("type") == "delete"
    image = F.when(gone, F.col("before")).otherwise(F.col("after"))
    rows = feed.select(
        *[image[n].alias(n) for n in names],
        F.coalesce(gone, F.lit(False)).alias("__gone"),
        F.col(seq).alias("__seq"),
    )
    return latest_rules(rows, "__seq").where("NOT __gone").drop("__gone", "__seq")


def latest_rules(rules: DataFrame, seq: str) -> DataFrame:
    """The last rule per (sourceTable, operateType)."""
    key = ["sourceTable", "operateType"]
    rest = [c for c in rules.columns if c not in key]
    return (
        rules.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__r"))
        .select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])
    )


def route_by_rules(
    df: DataFrame, rules: DataFrame, snapshot_as_insert: bool = True, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Attach the rule of each record and prune its cells to the rule's columns.

    ``rules`` holds one row per key (see ``latest_rules``). Adds ``sink_type`` (``unmatched``
    where no rule applies, so nothing is dropped silently), ``sink_table``, ``rowkey``, the name of
    the key cell (``id`` unless the rule names another), and ``key_value``, its content.

    There are only a few (table, type) keys, so a shuffle on them could not be balanced. The rule
    table is broadcast after its bytes were measured; a larger one is repeated over ``RULE_SALTS``
    salts that spread the records of a key.
    """
    side = rules.select(
        F.col("sourceTable").alias("__table"),
        F.col("operateType").alias("__type"),
        "sinkType",
        "sinkTable",
        F.split("sinkColumns", ",").alias("__columns"),
        "sinkPk",
    )
    kind = F.col("type")
    if snapshot_as_insert:
        kind = F.when(kind == "read", F.lit("insert")).otherwise(kind)
    same = (F.col("table") == F.col("__table")) & (kind == F.col("__type"))
    if within(side, max_bytes):
        joined = df.join(F.broadcast(side), same, "left")
    else:
        salts = F.sequence(F.lit(0), F.lit(RULE_SALTS - 1))
        spread = F.pmod(F.hash("table", "type", F.to_json("after")), F.lit(RULE_SALTS))
        joined = df.withColumn("__salt", spread).join(
            side.withColumn("__at", F.explode(salts)), same & (F.col("__salt") == F.col("__at")), "left"
        )
    matched = F.col("sinkType").isNotNull()
    pruned = F.map_filter("after", lambda k, _: F.array_contains(F.col("__columns"), k))
    pk = F.when(F.trim(F.coalesce("sinkPk", F.lit(""))) == "", F.lit("id")).otherwise(
        F.col("sinkPk")
    )
    return joined.select(
        *[c for c in df.columns if c != "after"],
        F.when(matched, pruned).otherwise(F.col("after")).alias("after"),
        F.coalesce("sinkType", F.lit(UNMATCHED)).alias("sink_type"),
        F.col("sinkTable").alias("sink_table"),
        F.when(matched, pk).alias("rowkey"),
        F.when(matched, F.col("after")[pk]).alias("key_value"),
    )


def split_routes(routed: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per route: broker, dimension store, OLAP store, unmatched."""
    return {
        kind: routed.where(F.col("sink_type") == kind)
        for kind in (SINK_KAFKA, SINK_DIM, SINK_OLAP, UNMATCHED)
    }


def sink_schema(sink_columns: str | None, sink_pk: str | None) -> T.StructType:
    """All-text schema of a dimension table named by a rule; its key is not null."""
    pk = sink_pk.strip() if sink_pk and sink_pk.strip() else "id"
    names = sink_columns.split(",") if sink_columns else []
    if pk not in names:
        names = [pk, *names]
    return T.StructType([T.StructField(n, T.StringType(), n != pk) for n in names])
