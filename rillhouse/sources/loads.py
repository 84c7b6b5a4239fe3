"""Ways of loading a table again: incremental, full, new and changed rows, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.operators.shape import union_all


def incremental(source: DataFrame, loaded: DataFrame, mark: str) -> DataFrame:
    """Source rows beyond the highest mark already loaded; all rows if nothing is.

    The mark is one value, fetched first, so that the filter can reach the scan.
    """
    high = loaded.agg(F.max(mark).alias("m")).first()["m"]
    if high is None:
        return source
    return source.where(F.col(mark) > F.lit(high).cast(source.schema[mark].dataType))


def new_and_changed(target: DataFrame, changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The target with changed rows replaced and new ones added: whole-row latest per key."""
    rest = [c for c in target.columns if c != key]
    rows = union_all([target, changes.select(target.columns)])
    return (
        rows.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__r"))
        .select(key, *[F.col(f"__r.{c}").alias(c) for c in rest])
        .select(target.columns)
    )


def full(source: DataFrame, path: str) -> None:
    source.write.mode("overwrite").parquet(path)


def once(spark: SparkSession, source: DataFrame, path: str) -> bool:
    """Load only if there is no finished load yet; tells whether rows were written."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        return False
    source.write.mode("overwrite").parquet(path)
    return True
