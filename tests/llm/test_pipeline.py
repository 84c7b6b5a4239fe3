"""The pipeline stage by stage against plain Python."""

import hashlib
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import pytest

from rillhouse.llm import mixing, toxicity
from tests.llm.test_mixing_simhash import plain_groups
from tests.llm.test_substring import brute
from tests.llm.test_token_operators import expected_pieces


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """What each stage got and gave, as ``(input, output)`` by name."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(steps):
    for name, (docs, out) in list(steps.items())[:-1]:
        assert out.dtypes == docs.dtypes, name


def test_toxicity(spark, sf, steps):
    docs, out = steps["toxicity"]
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert Counter(pairs(out)) == Counter(p for p in pairs(docs) if model.score(p[1]) < 0.7)
    assert out.count() < docs.count()


def test_simhash(steps):
    docs, out = steps["simhash"]
    rows = pairs(docs)
    firsts = {c for *_, c in plain_groups(rows)}
    assert Counter(pairs(out)) == Counter(p for p in rows if p[0] in firsts)
    assert len(firsts) < len(rows)


def test_substring(steps):
    docs, out = steps["substring"]
    want = {k[0]: k[1:] for k in brute(pairs(docs), 50)}
    before, after = dict(pairs(docs)), dict(pairs(out))
    for doc_id, (n, removed, digest) in want.items():
        if removed == 0:
            assert after[doc_id] == before[doc_id]
        elif removed == n:
            assert doc_id not in after
        else:
            assert hashlib.sha256(after[doc_id].encode()).hexdigest() == digest
    assert all(r.n_chars == len(r.text) for r in out.collect() if want[r.doc_id][1])


def test_mixing(steps):
    docs, out = steps["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert Counter(pairs(out)) == Counter(
        {p: copies[p[0]] for p in pairs(docs) if copies[p[0]]}
    )


def test_packing(steps, spark, sf):
    docs, out = steps["packing"]
    want = [p[:4] for p in expected_pieces(pairs(docs))]
    got = [(r.doc_id, r.piece, r.start, r.length) for r in out.collect()]
    assert sorted(got) == sorted(want)
    again = entry.queries()["pipeline"](spark, sf)
    assert Counter((r.doc_id, r.piece) for r in again.collect()) == Counter(p[:2] for p in want)


def test_empty_table_and_nulls(spark, documents, sf):
    for rows in ([], [(1, None), (None, None), (None, "a"), (2, ""), (2, ""), (3, "w " * 3000)]):
        docs = documents(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        got = docs.collect()
        assert len(got) > 0 or not rows
