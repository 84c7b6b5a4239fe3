"""Deficit round-robin packing: exact round trips, proportions, cases without text."""

from collections import defaultdict

import numpy as np
import pytest

from rillhouse.llm import mixture_packing
from rillhouse.llm.queries import vocabulary


@pytest.fixture(scope="module")
def vocab():
    return vocabulary("byte_bpe_50k.json")


def whole(vocab, text, end=1):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(vocab).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4").tobytes()


def checked(found, capacity):
    """Sequences by number: gapless, full but for a tail of powers of two. Gives the stream."""
    held = defaultdict(list)
    for r in found:
        held[r["sequence_id"]].append(r)
    stream, lengths = [], []
    for number in sorted(held):
        at = 0
        for r in sorted(held[number], key=lambda r: r["offset"]):
            assert r["offset"] == at and len(r["ids"]) == 4 * r["length"] and r["length"] > 0
            at += r["length"]
            stream.append(r)
        lengths.append(at)
    full = [n for n in lengths if n == capacity]
    tail = [n for n in lengths if n != capacity]
    assert all(n & (n - 1) == 0 for n in tail) and len(set(tail)) == len(tail)
    assert lengths == full + tail
    return stream


def documents_of(found):
    docs = defaultdict(list)
    for r in found:
        docs[r["doc_id"], r["doc_tokens"]].append(r)
    return docs


def test_every_id_once_and_no_padding(spark, sf, vocab):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = mixture_packing.pack(docs, vocab).collect()
    checked(found, 2048)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = documents_of(found)
    assert {d for d, _ in seen} == set(texts)
    for (doc, tokens), parts in seen.items():
        parts.sort(key=lambda r: r["start"])
        assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)])[:-1].tolist()
        assert b"".join(bytes(r["ids"]) for r in parts) == whole(vocab, texts[doc])
        assert sum(r["length"] for r in parts) == tokens


def test_proportions_hold_in_every_window(spark, documents, vocab, monkeypatch):
    monkeypatch.setattr(mixture_packing, "PER_TASK", 20)
    texts = [(i, f"word{i} " * (i % 37 + 1), "hot" if i % 3 else f"s{i % 4}") for i in range(300)]
    found = mixture_packing.pack(documents(texts), vocab, capacity=256, packet=64).collect()
    stream = checked(found, 256)
    totals = defaultdict(int)
    for r in stream:
        totals[r["source"]] += r["length"]
    total = sum(totals.values())
    served, at = defaultdict(int), 0
    for r in stream:
        served[r["source"]] += r["length"]
        at += r["length"]
        for source, n in totals.items():
            # a packet and a round of its own, at most, from its share
            assert abs(served[source] - at * n / total) <= 64 * len(totals) + 256


def test_weights(spark, documents, vocab):
    texts = [(i, "one two three four", "ab"[i % 2]) for i in range(400)]
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    found = mixture_packing.pack(documents(texts), vocab, capacity=128, packet=16, weights=weights)
    stream = checked(found.collect(), 128)
    half = stream[: len(stream) // 2]
    share = sum(r["length"] for r in half if r["source"] == "a") / sum(r["length"] for r in half)
    assert 0.72 < share < 0.78


def test_nulls_repeats_and_clashes(spark, vocab):
    schema = "doc_id long, text string, source string, key long, tokens long, salt int, round long, begin long"
    rows = [
        (1, None, "a"), (1, None, "a"), (2, "", None), (None, "x y", None), (3, "z " * 3000, "a"),
        (3, "other", "a"), (4, "same", "b"), (4, "same", "b"),
    ]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], schema)
    found = mixture_packing.pack(docs, vocab).collect()
    stream = checked(found, 2048)
    assert sum(r["length"] for r in stream) == sum(len(whole(vocab, t)) // 4 for _, t, _ in rows)
    assert sorted(r["doc_tokens"] for r in found if r["doc_id"] == 1) == [1, 1]
    again = mixture_packing.pack(docs.repartition(5), vocab).collect()
    key = lambda r: (r["sequence_id"], r["offset"], str(r["doc_id"]), r["start"], r["length"])
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_empty_table(documents, vocab):
    assert mixture_packing.pack(documents([]), vocab).collect() == []


def test_tail_is_cut_into_powers_of_two():
    assert mixture_packing.tail_edges(2048 + 1300, 2048) == [3072, 3328, 3344, 3348]
    assert mixture_packing.tail_edges(4096, 2048) == []
    assert mixture_packing.tail_edges(7, 5) == [7]
