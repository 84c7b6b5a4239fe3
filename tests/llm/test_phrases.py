"""Phrase mining against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from rillhouse.llm import phrases
from tests.conftest import rows

SCHEMA = "doc_id long, text string, lang string, block long, fp long, at int, times int, n int"


def docs(spark, given):
    return spark.createDataFrame(
        [(i, t, c, 1, 2, 3, 4, 5) for i, (t, c) in enumerate(given)], SCHEMA
    )


def brute(given, least, longest=5):
    counts, totals = Counter(), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for text, lang in given:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            lang = "und" if lang is None else lang
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for b in range(len(words) - m + 1):
                    counts[lang, tuple(words[b : b + m])] += 1
    frequent = {k: v for k, v in counts.items() if v >= least}
    out = []
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = frequent[lang, words[:k]], frequent[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        held = any(
            lang == other and len(longer) > len(words) and 100 * f >= 100 * a
            and any(longer[b : b + len(words)] == words for b in range(len(longer)))
            for (other, longer), f in frequent.items()
        )
        if not held:
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(words), a, left, right, totals[lang], score))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def corpus(seed=3, size=120):
    rng = np.random.default_rng(seed)
    names = ["the", "The", "river", "bank", "of", "a", "a", "é", "ß", "x" * 300, "new york", "...", "\t"]
    given = []
    for i in range(size):
        picked = rng.choice(names, size=rng.integers(0, 60))
        joins = rng.choice([" ", " ", " ", "  ", ", ", "\n", ". ", "\x0b", " \t"], size=len(picked))
        lang = [None, "und", "en", "fr", ""][i % 5]
        given.append(("".join(a + b for a, b in zip(picked, joins)), lang))
    return [*given, (None, "en"), ("", "fr"), ("a a a a a a a a", "en"), ("one, two", None)] + given[:9]


@pytest.mark.parametrize("bits,block_bytes", [(64, 2 << 20), (32, 700), (9, 700), (27, 3000)])
def test_equals_brute_force(spark, bits, block_bytes):
    given = corpus()
    expected = brute(given, 6)
    assert len(expected) > 40
    found = phrases.mine(docs(spark, given), 6, bits=bits, block_bytes=block_bytes)
    assert rows(found, "lang", "phrase", "a", "l", "r", "n", "score") == expected


def test_rank_is_by_score_count_and_bytes(spark):
    found = phrases.mine(docs(spark, corpus()), 6)
    every = [tuple(r) for r in found.select("lang", "score", "a", "phrase").collect()]
    first = phrases.top(found, 4).select("lang", "rank", "phrase").collect()
    for lang in {r[0] for r in every}:
        order = sorted((-s, -a, p.encode()) for c, s, a, p in every if c == lang)[:4]
        got = sorted((r[1], r[2]) for r in first if r[0] == lang)
        assert got == [(k, p.decode()) for k, (_, _, p) in enumerate(order, 1)]


def test_empty_and_wordless(spark):
    assert rows(phrases.mine(docs(spark, []), 1)) == []
    assert rows(phrases.mine(docs(spark, [(None, "en"), ("", None), (" .\n", "en")]), 1)) == []


def test_long_texts_are_cut_at_breaks_only():
    text = b"aa bb, cc dd. ee" * 50
    parts = list(phrases.pieces_of(text, 40))
    assert b"".join(parts) == text and max(map(len, parts)) <= 40
    assert all(p[-1:] in b",." for p in parts[:-1])
    assert list(phrases.pieces_of(b"w " * 60, 40)) == [b"w " * 60, b""]


def test_scores_pass_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "p", 1, 3 * 10**11), ("en", "q", 1, 7 * 10**10 + 1), ("en", "p q", 2, 6 * 10**10 + 7)],
        "lang string, phrase string, n int, f long",
    )
    words = spark.createDataFrame([("en", 9 * 10**12 + 5)], "lang string, total long")
    (got,) = phrases.scored(counts, words).collect()
    a, left, right, n = 6 * 10**10 + 7, 3 * 10**11, 7 * 10**10 + 1, 9 * 10**12 + 5
    assert got["score"] == 1000 * a * n // (left * right)
