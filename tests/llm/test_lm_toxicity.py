"""Language-model scores against plain counting; the classifier on its table and its fairness."""

import math
import os
import zlib
from collections import Counter

import pytest

from rillhouse.llm import lm_scoring, queries, toxicity

DOCS = [(1, "a b a b a c"), (2, "c C d"), (3, None), (4, ""), (5, "e a b " * 3000), (None, "a b"), (2, "c C d")]


def plain_scores(rows, targets):
    """Counts by the words' buckets, in plain loops."""
    counts = {True: Counter(), False: Counter()}
    split = [
        (i, [("w", int(w)) for w in found[0]], [("f", int(f)) for f in found[1]], [("p", int(p)) for p in found[2]])
        for i, found in ((i, lm_scoring.buckets(t)) for i, t in rows)
    ]
    for i, *kinds in split:
        for kind in kinds:
            counts[False].update(kind)
            if i in targets:
                counts[True].update(kind)
    out = []
    for i, words, firsts, pairs in split:
        ce = []
        for c in (counts[True], counts[False]):
            n = sum(v for k, v in c.items() if k[0] == "w")
            logs = [
                math.log(
                    (c[p] + 20 * (c[w] + 0.5) / (n + 0.5 * lm_scoring.WORDS)) / (c[f] + 20)
                )
                for w, f, p in zip(words, firsts, pairs, strict=True)
            ]
            ce.append(-sum(logs) / len(logs) if logs else 0.0)
        out.append((-1 if i is None else i, len(words), *ce, ce[0] - ce[1]))
    return sorted(out)


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == pytest.approx(w, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("targets", [[1, 2, None, 2], []])
def test_scores(spark, documents, targets):
    docs = documents(DOCS).withColumnRenamed("lang", "score")
    named = spark.createDataFrame([(t,) for t in targets], "doc_id long")
    found = lm_scoring.score(docs, named)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ce_target, r.ce_background, r.score)
                 for r in found.collect())
    close(got, plain_scores(DOCS, {t for t in targets if t is not None}))
    assert lm_scoring.score(documents([]), named).count() == 0


def scores_by_words(rows, targets, vocabulary):
    """Counts of the words and pairs themselves."""
    split = [(i, (t or "").encode().lower().split()) for i, t in rows]
    grams = [(i, w, [b"", *w][: len(w)]) for i, w in split]
    out = []
    counts = [Counter(), Counter()]
    for i, words, before in grams:
        for c in counts if i in targets else counts[1:]:
            c.update(words)
            c.update(("first", f) for f in before)
            c.update(zip(before, words, strict=True))
    totals = [sum(v for k, v in c.items() if isinstance(k, bytes)) for c in counts]
    for i, words, before in grams:
        ce = []
        for c, n in zip(counts, totals, strict=True):
            logs = [
                math.log((c[f, w] + 20 * (c[w] + 0.5) / (n + 0.5 * vocabulary)) / (c["first", f] + 20))
                for w, f in zip(words, before, strict=True)
            ]
            ce.append(-sum(logs) / len(logs) if logs else 0.0)
        out.append((i, len(words), *ce, ce[0] - ce[1]))
    return sorted(out)


@pytest.mark.parametrize("floor", [None, 100])
def test_words_never_share_a_count(spark, documents, monkeypatch, floor):
    """So many words and pairs that buckets would be shared; several blocks, shards and tasks."""
    rows = [(k, " ".join(f"w{k * j * j % 20_011} w{j}" for j in range(400))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, rows[3][1])]
    if floor:
        monkeypatch.setattr(lm_scoring, "WORDS", floor)
    docs = documents(rows).repartition(3).select("doc_id", "text")
    named = spark.createDataFrame([(k,) for k in range(0, 60, 4)], "doc_id long")
    found = lm_scoring.score(docs, named, block=20_000, shard=50_000).drop("text")
    distinct = len({w for _, t in rows for w in (t or "").split()})
    assert distinct > 5000
    want = scores_by_words(rows, set(range(0, 60, 4)), distinct if floor else lm_scoring.WORDS)
    close(sorted(map(tuple, found.collect())), want)


def test_score_query(spark, sf, texts):
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    got = sorted(map(tuple, queries.op3_lm_scores(spark, sf).collect()))
    close(got, plain_scores(texts, good))


def test_toxicity_on_held_out_rows(spark, sf):
    sf = os.path.join(os.path.dirname(sf), "sf0.01")  # the smallest has too few labels
    got = {r.doc_id: r for r in queries.op2_toxicity(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    fold = [(x.toxic, got[x.doc_id]) for x in labels if got[x.doc_id].held_out]
    assert not [r for toxic, r in fold if toxic == 0 and r.predicted]
    by = {k: [r.score for toxic, r in fold if toxic == k] for k in (0, 1)}
    pairs = [(a, b) for a in by[1] for b in by[0]]
    assert sum(a > b for a, b in pairs) + sum(a == b for a, b in pairs) / 2 >= 0.9 * len(pairs)


def sentences():
    """Insults are toxic; a group is mentioned in more toxic than neutral texts."""
    rows, k = [], 0
    for n in range(600):
        insult = ["idiot", "scum", "moron"][n % 3] if n % 2 else ""
        group = "muslim" if n % 2 and n % 5 else ("christian" if n % 4 == 0 else "")
        rows.append((n, f"today the {group} neighbour number{n % 17} was {insult} seen outside", int(bool(n % 2))))
    return rows


def test_neutral_mentions_are_scored_alike(spark, documents):
    rows = sentences()
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    plain = toxicity.train(docs, labels, fairness=0.0)
    fair = toxicity.train(docs, labels, fairness=10.0)

    def gap(model):
        return abs(model.score("the muslim neighbour was seen") - model.score("the christian neighbour was seen"))

    assert gap(fair) < 0.25 * gap(plain) and gap(plain) > 0.05
    assert fair.score("the muslim neighbour was an idiot") > 0.7
    assert fair.score("the muslim neighbour was seen") < 0.5


def test_edges(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "x " * 50_000), (None, "idiot"), (3, "y")]).withColumnRenamed("lang", "score")
    none = spark.createDataFrame([(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 5 and {r.score for r in got} == {model.score("")}
    assert toxicity.reject(documents([]), none).count() == 0
    assert toxicity.reject(docs, none).columns == docs.columns
