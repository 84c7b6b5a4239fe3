from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillhouse.operators.joins import (
    within,
    broadcast_if_small,
    interval_join,
    lookup_enrich,
)
from tests.conftest import at, rows

FIVE = timedelta(seconds=5)


def pair(spark, left, right):
    one = spark.createDataFrame(left, "id STRING, name STRING, t1 TIMESTAMP")
    two = spark.createDataFrame(right, "id2 STRING, sex STRING, t2 TIMESTAMP")
    return one, two


def join(one, two, **kw):
    return interval_join(one, two, [("id", "id2")], "t1", "t2", -FIVE, FIVE, **kw)


def test_bounds_are_exclusive(spark):
    one, two = pair(
        spark,
        [("a", "x", at(0))],
        [
            ("a", "low", at(-5)),
            ("a", "in1", at(-4.999)),
            ("a", "in2", at(4.999)),
            ("a", "high", at(5)),
            ("b", "key", at(0)),
        ],
    )
    assert rows(join(one, two), "sex") == [("in1",), ("in2",)]
    both = join(one, two, lower_exclusive=False, upper_exclusive=False)
    assert rows(both, "sex") == [("high",), ("in1",), ("in2",), ("low",)]
    assert rows(join(one, two, lower_exclusive=False), "sex") == [("in1",), ("in2",), ("low",)]


def test_bounds_belong_to_the_left_side(spark):
    one, two = pair(spark, [("a", "x", at(0))], [("a", "m", at(60)), ("a", "n", at(-60))])
    out = interval_join(
        one, two, [("id", "id2")], "t1", "t2", timedelta(seconds=50), timedelta(seconds=70)
    )
    assert rows(out, "sex") == [("m",)]


def test_null_keys_and_times_match_nothing(spark):
    one, two = pair(
        spark, [(None, "x", at(0)), ("a", "y", None)], [(None, "m", at(0)), ("a", "n", None)]
    )
    assert join(one, two).count() == 0


def test_clashing_names_are_refused(spark):
    one, two = pair(spark, [], [])
    with pytest.raises(ValueError):
        interval_join(one, two.withColumnRenamed("id2", "id"), [("id", "id")], "t1", "t2", -FIVE, FIVE)


@pytest.mark.parametrize("cell", [None, timedelta(seconds=1), timedelta(seconds=7), timedelta(days=1)])
def test_equals_plain_condition_for_any_cell(spark, cell):
    """A hot key with a third of the rows, times before and after the epoch."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("n"),
        F.timestamp_micros((F.xxhash64("id") % 400_000_000).cast("long")).alias("t"),
    )
    one = base.where("n % 2 = 0").toDF("id", "name", "t1")
    two = base.where("n % 2 = 1").toDF("id2", "sex", "t2")
    got = join(one, two, cell=cell).select("name", "sex")
    want = one.join(
        two,
        (F.col("id") == F.col("id2"))
        & (F.col("t2") > F.col("t1") - F.expr("INTERVAL 5 SECOND"))
        & (F.col("t2") < F.col("t1") + F.expr("INTERVAL 5 SECOND")),
    ).select("name", "sex")
    assert rows(got) == rows(want)
    assert got.count() > 0


def test_interval_join_hashes_key_and_cell(spark):
    one, two = pair(spark, [("a", "x", at(0))], [("a", "m", at(1))])
    plan = join(one, two)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
    assert "(__cell" in plan.replace(" ", "") or "__cell" in plan


def test_lookup_keeps_misses_and_replaces_columns(spark):
    fact = spark.createDataFrame([(1, 7, "old"), (2, 8, "old"), (3, None, "old")], "n INT, k BIGINT, name STRING")
    dim = spark.createDataFrame([("7", "seven"), ("08", "padded"), (None, "nobody")], "ID STRING, NAME STRING")
    out = lookup_enrich(fact, dim, "k", "ID", {"name": "NAME"})
    assert rows(out, "n", "name") == [(1, "seven"), (2, None), (3, None)]
    assert rows(lookup_enrich(fact, dim, "k", "ID", {"name": "NAME"}, how="inner"), "n") == [(1,)]


def test_lookup_of_text_and_other_types(spark):
    dim = spark.createDataFrame([("7", "seven")], "ID STRING, NAME STRING")
    text = spark.createDataFrame([("7",)], "k STRING")
    decimal = spark.createDataFrame([(7,)], "k INT").select(F.col("k").cast("decimal(3,0)").alias("k"))
    for fact in (text, decimal):
        assert rows(lookup_enrich(fact, dim, "k", "ID", {"name": "NAME"}), "name") == [("seven",)]


def test_broadcast_is_checked(spark):
    small = spark.range(10)
    assert within(small, 1000) and not within(small, 80) and not within(small.limit(2), 20)

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(small, 1000))
    assert not hinted(broadcast_if_small(small, 100))
