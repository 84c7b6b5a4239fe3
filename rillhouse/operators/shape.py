"""Small reshaping operators."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_json_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """One JSON text per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(value))


def camel(name: str) -> str:
    return re.sub(r"_+([a-zA-Z0-9])", lambda m: m.group(1).upper(), name.lower())


def camel_columns(df: DataFrame) -> DataFrame:
    """``snake_case`` column names to ``camelCase``."""
    return df.toDF(*[camel(c) for c in df.columns])


def split_cast(df: DataFrame, value: str = "value", out: str = "number") -> DataFrame:
    """Space-separated text to one long per row."""
    parts = df.select(F.explode(F.split(F.col(value), " ")).alias(out))
    return parts.select(F.col(out).cast("long").alias(out))


def tag_side_output(
    df: DataFrame, column: str, tag: str = "sideout"
) -> tuple[DataFrame, DataFrame]:
    """The values themselves, and the same values as tagged text."""
    return df.select(column), df.select(
        F.concat(F.lit(f"{tag}-"), F.col(column).cast("string")).alias(column)
    )


def from_csv_lines(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Comma-separated lines to records."""
    rest = [c for c in df.columns if c != value]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.withColumn("__r", F.from_csv(value, ddl)).select(*rest, "__r.*")


def copy_fields(df: DataFrame, target: T.StructType) -> DataFrame:
    """Same-named scalar fields cast to the target record, missing ones null.

    Dates and timestamps become epoch milliseconds where the target is numeric; nested fields are
    not copied.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in target.fields:
        kind = have.get(field.name)
        col = F.col(f"`{field.name}`")
        if kind is None or isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            col = F.lit(None)
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) and isinstance(
            field.dataType, T.NumericType
        ):
            col = F.unix_millis(col.cast("timestamp"))
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of same-typed inputs by column name; works on streams."""
    return reduce(lambda a, b: a.unionByName(b), frames)
