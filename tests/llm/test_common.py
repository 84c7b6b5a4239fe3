"""Components and checked broadcasts."""

import random

import pytest

from rillhouse.llm import common


def roots_of(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


CASES = {
    "none": [],
    "loop": [(3, 3)],
    "chain": [(k, k + 1) for k in range(60)],
    "shuffled chain": [(a * 37 % 61, (a + 1) * 37 % 61) for a in range(60)],
    "star": [(0, k) for k in range(1, 300)],
    "repeats": [(5, 2), (2, 5), (5, 2), (-7, 2)],
}


@pytest.mark.parametrize("name", [*CASES, "random"])
def test_components(spark, name):
    rng = random.Random(2)
    links = CASES.get(name)
    if links is None:
        links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    got = common.components(spark.createDataFrame(links, "a long, b long"))
    want = roots_of([x for x in links if x[0] != x[1]])
    assert sorted((r.node, r.root) for r in got.collect()) == sorted(want.items())


@pytest.mark.parametrize("limit", [-1, 1 << 20])
def test_lookup_either_way(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    facts = spark.createDataFrame([(k, None if k % 3 == 0 else f"s{k % 3}") for k in range(50)], "i long, s string")
    small = common.stored(spark.createDataFrame([(None, 1), ("s1", 2)], "s string, v long"), "small")
    got = {(r.i, r.s, r.v) for r in common.lookup(facts, small, "s").collect()}
    assert got == {(k, None if k % 3 == 0 else f"s{k % 3}", {0: 1, 1: 2}.get(k % 3)) for k in range(50)}


@pytest.mark.parametrize("limit", [-1, 1 << 20])
def test_lookup_with_clashing_names(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    facts = spark.createDataFrame([(1, "s1", 5, 6)], "_KEY int, s string, _salt int, _right int")
    small = common.stored(spark.createDataFrame([("s1", 2, 9)], "s string, v int, _key_ int"), "small")
    got = common.lookup(facts, small, "s").select("_KEY", "_salt", "_right", "v", "_key_")
    assert [tuple(r) for r in got.collect()] == [(1, 5, 6, 2, 9)]


def test_arrow_rows_are_given_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), common.arrow_rows(spark, 3):
        assert spark.conf.get(name) == "3"
        raise ValueError
    assert spark.conf.get(name) == before
