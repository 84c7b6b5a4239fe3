"""Interval joins and closed windows over several micro-batches, with late rows and restarts."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillhouse.operators.joins import interval_join
from rillhouse.operators.themes import product_rows, product_stats
from rillhouse.session import stream_session
from rillhouse.sources import readers
from rillhouse.streaming import jobs
from rillhouse.streaming.run import run_paced
from tests.conftest import at, rows

SPAN = {"lower": timedelta(seconds=-60), "upper": timedelta(seconds=90)}
LEFT, RIGHT = "n long, id long, lt timestamp", "m long, rid long, rt timestamp"


@pytest.fixture(scope="module")
def session(spark):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


def stream(spark, session, path, data, schema, batches):
    df = spark.createDataFrame(data, schema).coalesce(1)
    df.write.parquet(str(path))
    return readers.counter_stream(session, str(path), -(-len(data) // batches), "place").drop("place")


def writer(path):
    def write(done, batch):
        done.write.mode("overwrite").parquet(f"{path}/out/batch={batch}")

    return write


def joined(left, right):
    return interval_join(left, right, [("id", "rid")], "lt", "rt", **SPAN)


def interval(spark, session, path, left, right, batches=4):
    ls = stream(spark, session, path / "l", left, LEFT, batches)
    rs = stream(spark, session, path / "r", right, RIGHT, batches)
    job = jobs.interval_job(
        ls, rs, "lt", "rt", SPAN["lower"], SPAN["upper"], joined, writer(path), f"{path}/held",
        f"{path}/state",
    )
    run_paced(job, stop_after=2)
    return spark.read.parquet(f"{path}/out")


def test_interval_job_meets_across_batches_and_a_restart(spark, session, tmp_path):
    rng = random.Random(5)
    left = [(n, rng.randrange(20), at(n * 10)) for n in range(400)]
    right = [(n, rng.randrange(20), at(n * 10 + 3)) for n in range(400)]
    left += [left[-1], (900, None, at(4000)), (901, 3, None)]
    right += [right[-1], (900, None, at(4000)), (901, 3, None)]
    found = interval(spark, session, tmp_path, left, right)
    want = joined(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT))
    columns = ["n", "id", "lt", "m", "rid", "rt"]
    assert rows(found, *columns) == rows(want, *columns)
    assert found.where("n div 101 <> m div 101").count() > 0
    # what no later row can meet is not kept
    kept = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/held/rows")
    assert 0 < kept.count() < 100


def test_interval_job_drops_rows_behind_the_watermark(spark, session, tmp_path):
    left = [(1, 7, at(0)), (2, 7, at(5000)), (3, 7, at(10)), (4, 7, at(5010))]
    right = [(1, 7, at(1)), (2, 7, at(5001)), (3, 7, at(2)), (4, 7, at(5050))]
    found = interval(spark, session, tmp_path, left, right, 2)
    assert rows(found, "n", "m") == [(1, 1), (2, 2), (2, 4), (4, 2), (4, 4)]


def test_interval_job_with_an_empty_side_keeps_everything(spark, session, tmp_path):
    ls = stream(spark, session, tmp_path / "l", [(n, 1, at(n)) for n in range(9)], LEFT, 3)
    rs = stream(spark, session, tmp_path / "r", [(1, 1, None)], RIGHT, 1)
    job = jobs.interval_job(
        ls, rs, "lt", "rt", SPAN["lower"], SPAN["upper"], joined, writer(tmp_path),
        f"{tmp_path}/held", f"{tmp_path}/state",
    )
    run_paced(job)
    kept = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/held/rows")
    assert kept.where("__l is not null").count() == 9


def test_closed_windows_come_whole_and_late_rows_do_not(spark, session, tmp_path):
    width, late = timedelta(seconds=100), timedelta(seconds=50)
    rng = random.Random(6)
    schema = "sku_id long, ts timestamp, order_id long"
    data = [(rng.randrange(3), at(n * 5 + rng.randrange(40)), rng.randrange(50)) for n in range(300)]
    data += [(1, None, 4), (9, at(0), 1), (9, at(100_000), 1)]
    facts = lambda df: product_rows(df, "ts", order_id=F.col("order_id"), order_sku_num=F.lit(1))
    source = stream(spark, session, tmp_path / "t", data, schema, 5)

    def summed(closed, batch):
        writer(tmp_path)(product_stats(closed, width), batch)

    job = jobs.closed_windows_job(
        facts(source), "event_ts", width, late, summed, f"{tmp_path}/held", f"{tmp_path}/state"
    )
    run_paced(job, stop_after=2)
    found = spark.read.parquet(f"{tmp_path}/out")
    timely = [r for r in data[:300]]
    want = product_stats(facts(spark.createDataFrame(timely, schema)), width)
    columns = ["stt", "edt", "sku_id", "order_ct", "order_sku_num", "ts"]
    assert rows(found, *columns) == rows(want, *columns)
    assert found.select("batch").distinct().count() >= 4
    # windows that are closed are no longer kept
    kept = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/held/rows")
    assert kept.where("sku_id = 9").count() == 1 and kept.count() < 150
