"""Hard negatives against plain Python."""

import math

import numpy as np
import pytest

from rillhouse.llm import hard_negatives
from tests.conftest import rows

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, slot int, a int, r int, dims int"


def vectors(spark, given):
    return spark.createDataFrame([(i, v, c, 1, 2, 3, 4, 5) for i, v, c in given], SCHEMA)


def brute(given, every=50, positives=5, negatives=3):
    kept = {}
    for i, v, c in given:
        if i is None or c is None or v is None:
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (c, [min(max(math.floor(256 * x), -(2**63)), 2**63 - 1) for x in v])
        kept[i] = min(kept.get(i, row), row)
    out = []
    for i, (c, v) in kept.items():
        if i % every:
            continue
        scores = [
            (max(-(2**63) + 1, min(sum(x * y for x, y in zip(v, w)), 2**63 - 1)), j, d == c)
            for j, (d, w) in kept.items()
            if j != i and len(w) == len(v)
        ]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scores if s[2]][:positives]:
            window = [s for s in scores if not s[2] and 50 * p <= 100 * s[0] <= 95 * p]
            for rank, (n, k, _) in enumerate(window[:negatives], 1):
                out.append((i, j, rank, k, p, n))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def mined(spark, given, **options):
    whole = hard_negatives.quantised(vectors(spark, given))
    return rows(hard_negatives.mine(whole, **options))


@pytest.mark.parametrize("blocks", [(1 << 19, 1 << 18), (64, 32)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "ROW_VALUES", blocks[0])
    monkeypatch.setattr(hard_negatives, "ANCHOR_VALUES", blocks[1])
    monkeypatch.setattr(hard_negatives, "CHUNK", 7)
    rng = np.random.default_rng(5)
    given = [(i, rng.normal(0.1, 0.2, 8).tolist(), int(i % 3)) for i in range(160)]
    # many equal vectors, so that scores tie
    given += [(200 + i, [0.25] * 8, i % 2) for i in range(60)]
    expected = brute(given, every=20)
    assert len(expected) > 60
    assert mined(spark, given, every=20) == expected


def test_rows_that_take_no_part_and_repeats(spark):
    rng = np.random.default_rng(6)
    given = [(i, rng.random(4).tolist(), i % 2) for i in range(30)]
    given += [
        (100, None, 0), (101, [0.5, None, 0.1, 0.2], 0), (102, [float("nan")] * 4, 1),
        (103, [float("inf")] * 4, 1), (104, [1.0] * 4, None), (None, [1.0] * 4, 1),
        (0, [9.0] * 4, 1), (3, given[3][1], 1), (3, [7.0] * 4, 1), (4, given[4][1], 0),
        (105, [0.0] * 4, 0), (106, [], 1), (107, [], 0), (108, [0.5] * 6, 0), (110, [0.4] * 6, 1),
        (109, [0.5] * 6, 0),
    ]
    expected = brute(given, every=3)
    assert expected and mined(spark, given, every=3) == expected


def test_scores_are_exact_beyond_doubles(spark):
    big = float(1 << 40)
    given = [(i, [big + i * 257.0, big, 3.0 * i], i % 2) for i in range(12)]
    given += [(20 + i, [big * 1e9, -big * 1e9, 1.0], i % 2) for i in range(3)]
    assert mined(spark, given, every=4) == brute(given, every=4)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_a_slot_gives_its_best_to_all_windows_above():
    run = hard_negatives.merged(2)
    import pyarrow as pa

    windows = [
        {"upper": 90, "lower": 40, "positive_score": 95, "positive_id": 1},
        {"upper": 70, "lower": 65, "positive_score": 74, "positive_id": 2},
        {"upper": 50, "lower": 10, "positive_score": 53, "positive_id": 3},
    ]
    slots = [
        {"slot": 1, "score": 80, "vec_id": 7}, {"slot": 2, "score": 66, "vec_id": 8},
        {"slot": 2, "score": 60, "vec_id": 9}, {"slot": 3, "score": 20, "vec_id": 4},
    ]
    batch = pa.RecordBatch.from_pylist([{"anchor_id": 0, "windows": windows, "slots": slots}])
    got = [(r["positive_id"], r["rank"], r["negative_id"]) for b in run([batch])
           for r in b.to_pylist()]
    assert sorted(got) == [(1, 1, 7), (1, 2, 8), (2, 1, 8), (3, 1, 4)]
