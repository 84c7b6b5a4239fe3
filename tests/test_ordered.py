"""Operators over time order against direct definitions in Python."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillhouse.operators.ordered import (
    correct_new_flag,
    entry_pattern,
    first_per_day,
    running,
    sessions,
)
from tests.conftest import at, rows

SCHEMA = "mid STRING, ts TIMESTAMP, tie BIGINT, entry BOOLEAN, flag STRING, value BIGINT"


def made(n=1500, seed=5, span=40_000):
    """Random events; one key holds a third of them, some times repeat."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        out.append((key, at(rng.randrange(span)), i, rng.random() < 0.6, rng.choice("01"), rng.randrange(9)))
    out.append((None, at(5), n, True, "1", 1))
    return out


def by_key(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in groups.items()}


@pytest.fixture(scope="module")
def data():
    return made()


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def jumps(data, horizon):
    out = []
    for group in by_key(data).values():
        for e, n in zip(group, group[1:] + [None]):
            near = n is not None and n[1] - e[1] < horizon
            if e[3] and (not near or n[3]):
                out.append((e[2], "match" if near else "timeout"))
    return sorted(out)


@pytest.mark.parametrize("cell", [None, timedelta(seconds=10), timedelta(minutes=3)])
def test_entry_pattern(df, data, cell):
    horizon = timedelta(seconds=10)
    got = entry_pattern(df, "mid", "ts", "tie", F.col("entry"), horizon, cell)
    assert sorted((r.tie, r.how) for r in got.collect()) == jumps(data, horizon)


def test_entry_pattern_edges(spark):
    data = [
        ("exact", at(0), 1, True, "0", 0),  # successor exactly at the horizon: too late
        ("exact", at(10), 2, True, "0", 0),
        ("near", at(0), 3, True, "0", 0),  # successor just inside
        ("near", at(9.999), 4, True, "0", 0),
        ("broken", at(0), 5, True, "0", 0),  # a non-entry record comes first
        ("broken", at(1), 6, False, "0", 0),
        ("broken", at(2), 7, True, "0", 0),
        ("single", at(0), 8, True, "0", 0),
        ("tied", at(0), 9, True, "0", 0),
        ("tied", at(0), 10, False, "0", 0),
    ]
    got = entry_pattern(
        spark.createDataFrame(data, SCHEMA), "mid", "ts", "tie", F.col("entry"), timedelta(seconds=10)
    )
    assert rows(got, "tie", "how") == [
        (1, "timeout"), (2, "timeout"), (3, "match"), (4, "timeout"), (7, "timeout"), (8, "timeout")
    ]


@pytest.mark.parametrize("cell", [timedelta(seconds=30), timedelta(hours=1), timedelta(days=30)])
def test_running(df, data, cell):
    got = running(
        df, "mid", "ts", "tie", {"total": F.col("value"), "n": F.lit(1)}, cell
    )
    want = []
    for group in by_key(data).values():
        total = 0
        for n, r in enumerate(group, 1):
            total += r[5]
            want.append((r[2], total, n))
    assert sorted((r.tie, r.total, r.n) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("cell", [None, timedelta(seconds=40), timedelta(days=30)])
def test_sessions(df, data, cell):
    gap = timedelta(seconds=100)
    want = []
    for key, group in by_key(data).items():
        start, last, n = None, None, 0
        for r in group:
            if last is not None and r[1] - last >= gap:
                want.append((key, start, last + gap, n))
                start, n = None, 0
            start = start or r[1]
            last, n = r[1], n + 1
        want.append((key, start, last + gap, n))
    got = sessions(df, ["mid"], "ts", gap, cell).collect()
    plain = [
        (r.mid, r.session_start.astimezone(), r.session_end.astimezone(), r.n) for r in got
    ]
    assert sorted(plain, key=str) == sorted(
        [(k, s.astimezone(), e.astimezone(), n) for k, s, e, n in want], key=str
    )


def test_first_per_day(df, data):
    first = {}
    for r in data:
        if r[3]:
            key = (r[0], r[1].date())
            if key not in first or (r[1], r[2]) < first[key]:
                first[key] = (r[1], r[2])
    got = first_per_day(df, "mid", "ts", "tie", F.col("entry"))
    assert sorted(r.tie for r in got.collect()) == sorted(v[1] for v in first.values())


def test_first_per_day_limits_groups_before_the_exchange(df):
    plan = first_per_day(df, "mid", "ts", "tie")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_correct_new_flag(df, data):
    want = []
    for group in by_key(data).values():
        seen = False
        for r in group:
            keeps = r[4] == "1" and not seen
            seen = seen or r[4] == "1"
            want.append((r[2], "1" if keeps else "0"))
    got = correct_new_flag(df, "mid", "flag", "ts", "tie")
    assert sorted((r.tie, r.flag) for r in got.collect()) == sorted(want)


def test_correct_new_flag_after_an_old_record(spark):
    """A record flagged old does not use up the first new one."""
    data = [("a", at(0), 1, True, "0", 0), ("a", at(1), 2, True, "1", 0), ("a", at(2), 3, True, "1", 0)]
    got = correct_new_flag(spark.createDataFrame(data, SCHEMA), "mid", "flag", "ts", "tie")
    assert rows(got, "tie", "flag") == [(1, "0"), (2, "1"), (3, "0")]
