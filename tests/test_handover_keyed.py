"""Snapshot to log, and lookups that read a part of a dimension."""

import random

import pytest
from pyspark.sql import functions as F

from rillhouse.operators import handover, keyed
from tests.conftest import rows

LOG = "id long, pos long, type string, v string"


@pytest.mark.parametrize("seed", range(3))
def test_handover_equals_the_log_alone(spark, seed):
    rng = random.Random(seed)
    log = [
        (rng.randrange(30), pos, "delete" if rng.random() < 0.15 else "update", f"v{pos}")
        for pos in range(1, 400)
    ]
    changes = spark.createDataFrame(log, LOG).withColumn("chunk", (F.col("id") % 3).cast("int"))
    ticks = iter([50, 120, 120, 200, 230, 330])
    state = {"at": 0}

    def position():
        state["at"] = next(ticks)
        return state["at"]

    def read(chunk):  # anywhere between the marks
        high = {50: 120, 120: 200, 230: 330}[state["at"]]
        seen = rng.randint(state["at"], high)
        return handover.latest(changes.drop("chunk").where(
            (F.col("id") % 3 == chunk) & (F.col("pos") <= seen)), "id", "pos")

    snapshot, marks = handover.read_chunks(spark, range(3), read, position)
    standing = handover.reconciled(snapshot, marks, changes, "id", "pos")
    fresh = handover.after_snapshot(changes, marks, "pos")
    records = standing.unionByName(fresh)
    want = {}
    for i, pos, kind, v in log:
        want[i] = None if kind == "delete" else v
    assert rows(handover.latest(records, "id", "pos"), "id", "v") == sorted(
        ((i, v) for i, v in want.items() if v is not None), key=lambda r: tuple(map(str, r))
    )
    # a version of a key comes once, and a snapshot's row never beside a change of its window
    low = {0: 50, 1: 120, 2: 230}
    high = {0: 120, 1: 200, 2: 330}
    reads = {i: pos for i, pos, kind in rows(records.where("type = 'read'"), "id", "pos", "type")}
    assert all(pos == low[i % 3] for i, pos in reads.items())
    assert not {i for i, pos, *_ in log if low[i % 3] < pos <= high[i % 3]} & set(reads)
    assert records.select("id", "pos").distinct().count() == records.count()


def test_handover_without_chunks_or_changes(spark):
    empty = spark.createDataFrame([], LOG)
    snapshot, marks = handover.read_chunks(
        spark, [7], lambda _: spark.createDataFrame([(1, "a")], "id long, v string"), lambda: 5
    )
    log = empty.withColumn("chunk", F.lit(7))
    assert rows(handover.reconciled(snapshot, marks, log, "id", "pos"), "id", "v", "pos") == [(1, "a", 5)]
    other = spark.createDataFrame([(2, 1, "update", "b")], LOG).withColumn("chunk", F.lit(8))
    assert rows(handover.after_snapshot(other, marks, "pos"), "id") == [(2,)]
    with pytest.raises(ValueError):
        handover.read_chunks(spark, [], lambda _: empty, lambda: 0)


DIM = [(i, f"n{i}") for i in range(500)]


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_lookup_reads_only_touched_buckets(spark, tmp_path, buckets):
    dim = spark.createDataFrame(DIM, "k long, name string")
    path = str(tmp_path / "dim")
    keyed.write_keyed(dim, path, "k", buckets)
    facts = spark.createDataFrame([(1, 3), (2, 77), (3, 3), (4, None), (5, 9999)], "f int, user int")
    found = keyed.lookup_keyed(facts, path, dim.schema, "user", "k", {"name": "name"}, buckets=buckets)
    assert rows(found) == [(1, 3, "n3"), (2, 77, "n77"), (3, 3, "n3"), (4, None, None), (5, 9999, None)]
    asked = keyed.asked_for(spark, path, dim.schema, facts, "user", "k", buckets)
    assert 2 <= asked.count() <= 10
    bits = keyed.filter_bits(facts, "user")
    hit = {r.b for r in dim.where("k in (3, 77)").select(keyed._bucket("k", buckets).alias("b")).collect()}
    picked = keyed.touched(bits, buckets)
    assert hit <= set(picked) and len(picked) <= 4
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    if buckets > 1:
        whole = dim.schema.fromJson(dim.schema.jsonValue()).add("bucket", "integer")
        read = keyed.pruned(spark, path, whole, picked).select("_metadata.file_path").distinct()
        assert read.count() <= 4 < len(spark.read.parquet(path).inputFiles())


def test_update_rewrites_touched_buckets_only(spark, tmp_path):
    path = tmp_path / "dim"
    dim = spark.createDataFrame(DIM, "k long, name string")
    keyed.update_keyed(spark, str(path), dim, "k", 32)
    before = {f: f.stat().st_mtime_ns for f in path.glob("bucket=*/*.parquet")}
    changes = spark.createDataFrame([(3, "new"), (1000, "more")], "k long, name string")
    for _ in range(2):  # the same changes may come again
        keyed.update_keyed(spark, str(path), changes, "k", 32)
    kept = [f for f, at in before.items() if f.exists() and f.stat().st_mtime_ns == at]
    assert len(kept) >= 30
    want = {**dict(DIM), 3: "new", 1000: "more"}
    assert dict(rows(spark.read.schema(dim.schema).parquet(str(path)), "k", "name")) == want
    with pytest.raises(ValueError):
        keyed.write_keyed(dim, str(tmp_path / "x"), "k", 100)


def test_no_facts_read_nothing(spark, tmp_path):
    dim = spark.createDataFrame(DIM, "k long, name string")
    keyed.write_keyed(dim, str(tmp_path / "d"), "k", 16)
    facts = spark.createDataFrame([], "f int, user string")
    found = keyed.lookup_keyed(facts, str(tmp_path / "d"), dim.schema, "user", "k", {"name": "name"}, buckets=16)
    assert rows(found) == []
