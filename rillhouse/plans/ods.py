"""Raw layer: change records as normalised JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.operators.cdc import normalize_cdc

TOPIC_LOG = "ods_base_log"
TOPIC_DB = "ods_base_db"


def base_db_lines(changes: DataFrame) -> DataFrame:
    """One envelope per change record, as (topic, value)."""
    names = schemas.CDC_ENVELOPE.fieldNames()
    return normalize_cdc(changes).select(
        F.lit(TOPIC_DB).alias("topic"), F.to_json(F.struct(*names)).alias("value")
    )


def read_base_db(lines: DataFrame, value: str = "value") -> DataFrame:
    """Envelopes back from their lines; other columns are kept."""
    rest = [c for c in lines.columns if c not in ("topic", value)]
    return lines.withColumn("__r", F.from_json(value, schemas.CDC_ENVELOPE)).select(
        *rest, "__r.*"
    )
