"""Which sides of joins may be broadcast: only those whose rows were measured."""

import random

import pytest

from rillhouse.llm import common, packing, simhash, substring


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_are_not_broadcast_by_the_size_of_the_fingerprints(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(63) for _ in range(300)]
    near = [p ^ 1 << rng.randrange(63) for p in prints[:40]]
    marks = common.stored(spark.createDataFrame([(p,) for p in prints + near], "fp long"), "marks")
    pairs = simhash.close_pairs(marks)
    assert "Broadcast" not in planned(pairs)
    got = {tuple(r) for r in pairs.collect()}
    assert got == {(min(x), max(x)) for x in zip(prints, near, strict=False)}


def test_sides_beyond_the_limit_are_shuffled(spark, monkeypatch):
    rows = common.stored(spark.createDataFrame([(k, "x") for k in range(9)], "k long, t string"), "side")
    facts = spark.range(50).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in planned(facts.join(common.sized(rows), "k"))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 100)
    assert "Broadcast" not in planned(facts.join(common.sized(rows), "k"))
    assert "BroadcastHashJoin" in planned(facts.join(common.sized(rows, 100), "k"))


def test_salted_rows_are_not_broadcast_by_the_size_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    facts = spark.createDataFrame([(k % 7, k) for k in range(60)] + [(None, 60)], "s long, i long")
    small = common.stored(spark.createDataFrame([(k, 10 * k) for k in range(5)] + [(None, 99)], "s long, v long"), "small")
    for how in ("left", "inner"):
        found = common.lookup(facts, small, "s", how)
        assert "Broadcast" not in planned(found)
        want = {(k, None if k % 7 > 4 else 10 * (k % 7)) for k in range(60)} | {(60, 99)}
        assert {(r.i, r.v) for r in found.collect()} == {x for x in want if how == "left" or x[1] is not None}


@pytest.mark.parametrize("limit", [-1, 1 << 20])
def test_groups_either_way(spark, documents, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    docs = documents([(k, f"one two three {k // 3} five") for k in range(12)] + [(None, "other"), (20, None)])
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {x for x in got if x[0] is not None and x[0] < 12 and x[0] % 3 == 1} >= {(1, 0), (4, 3)}
    chain = [(k, k + 1) for k in range(30)] + [(50, 40)]
    found = common.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {**dict.fromkeys(range(31), 0), 40: 40, 50: 40}
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect() if r.doc_id is not None) == sorted(
        {c for _, c in got if c is not None}
    )


def test_spans_and_shifts_are_not_broadcast_beyond_the_limit(spark, documents, monkeypatch):
    passage = " ".join(f"w{k}" for k in range(70))
    docs = documents([(1, passage), (2, f"other {passage} end"), (3, "short")]).select("doc_id", "text")
    cut = common.stored(spark.createDataFrame(
        [(k, 0, 0, 10 + k % 3, b"") for k in range(12)], packing.PIECES), "pieces")
    found = {}
    for limit in (1 << 23, -1):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        kept, placed = substring.dedup(docs), packing.place(cut, 64)
        if limit < 0:
            assert "Broadcast" not in planned(kept) + planned(placed)
        found[limit] = [sorted(tuple(r) for r in x.collect()) for x in (kept.select("doc_id", "n_removed"), placed)]
    assert found[-1] == found[1 << 23]
    assert found[-1][0] == [(1, 0), (2, 70), (3, 0)]
