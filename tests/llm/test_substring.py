"""Repeated passages against plain comparison of all windows, and the index against search."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillhouse.llm import queries, substring
from rillhouse.llm.fm_index import FMIndex


def brute(rows, window):
    """``(doc_id, n_words, n_removed, kept words)`` per row, as the contract says it."""
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df):
    return Counter(
        tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    )


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=20), min_size=1, max_size=7),
    st.lists(st.integers(0, 3), min_size=8, max_size=30),
    st.integers(1, 6),
)
def test_index_finds_what_search_finds(passages, text, depth):
    owners = np.arange(len(passages))[::-1].copy()
    index = FMIndex([np.array(p, np.uint64) for p in passages], owners, depth)
    begins = np.arange(len(text) - depth + 1)
    own = np.full(len(begins), len(passages) // 2 + 1)
    got = index.smallest_owner(np.array(text, np.uint64), begins, own)
    for b, g in zip(begins, got, strict=True):
        held = [
            o for p, o in zip(passages, owners, strict=True)
            if any(p[k : k + depth] == text[b : b + depth] for k in range(len(p) - depth + 1))
        ]
        assert g == min([len(passages) // 2 + 1, *held])


def made(seed, n, vocabulary=300):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    shared = [[word() for _ in range(rng.randrange(40, 90))] for _ in range(4)]
    copy = [word() for _ in range(200)]
    rows = []
    for i in range(n):
        text = [word() for _ in range(rng.randrange(0, 120))]
        kind = rng.randrange(5)
        if kind < 2:
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(shared)
        elif kind == 2:
            text = list(copy)
        elif kind == 3:
            text = list(copy)
            for _ in range(rng.randrange(1, 4)):
                text[rng.randrange(len(text))] = word()
        else:
            text += ["again"] * rng.randrange(0, 130)
        rows.append((rng.randrange(10 * n), rng.choice([" ", "\n", "  "]).join(text)))
    return rows


@pytest.mark.parametrize("per_index", [2, 4096])
def test_against_all_windows(spark, documents, monkeypatch, per_index):
    monkeypatch.setattr(substring, "PER_INDEX", per_index)
    monkeypatch.setattr(substring, "PER_TASK", 10)
    rows = made(3, 120) + [(5, None), (None, "x " * 80), (None, "x " * 80), (7, ""), (8, " \n")]
    rows += [(9, "x " * 90), (9, "x " * 90), (9, "x " * 60), (-1, "nb\xa0sp " * 49)]
    assert found(substring.dedup(documents(rows))) == brute(rows, 50)


def test_small_windows(spark, documents):
    rows = made(4, 60, vocabulary=4)
    assert found(substring.dedup(documents(rows), window=6)) == brute(rows, 6)


def test_empty_table_and_clashing_columns(spark, documents):
    docs = documents([]).withColumnRenamed("lang", "spans").withColumnRenamed("source", "kept")
    assert substring.dedup(docs).count() == 0
    docs = documents([(1, "a " * 60), (2, "a " * 60)]).withColumnRenamed("lang", "spans")
    assert found(substring.dedup(docs)) == brute([(1, "a " * 60), (2, "a " * 60)], 50)


def test_query(spark, sf, texts):
    got = queries.op8_remove_repeats(spark, sf)
    assert found(got) == brute(texts, 50)
    assert sum(r.n_removed for r in got.collect()) > 0
