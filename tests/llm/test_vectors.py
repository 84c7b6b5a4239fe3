"""Search and groups of vectors against all pairs."""

import numpy as np
import pytest

from rillhouse.llm import ann_search, pq_dedup, queries

SCHEMA = "vec_id long, embedding array<float>, label int, list int"
BAD = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [1.0] * 5]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1) for i, v in rows], SCHEMA)


def good(rows):
    out = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
           if i is not None and v and len(v) == 8 and None not in v
           and np.isfinite(v).all() and np.any(v)]
    return [i for i, _ in out], np.array([v / np.linalg.norm(v) for _, v in out])


def noisy(n, seed=1, groups=12):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((groups, 8))
    rows = []
    for i in range(n):
        v = rng.standard_normal(8)
        if i % 3 == 0:
            v = base[rng.integers(groups)] + 0.12 * rng.standard_normal(8)
        if i % 11 == 0:
            v = base[0]
        rows.append((int(i), [float(x) for x in v * rng.choice([0.5, 1.0, 3.0])]))
    return rows + [(n + k, v) for k, v in enumerate(BAD)] + [(None, [1.0] * 8)]


def plain_groups(rows, least=0.95):
    ids, unit = good(rows)
    near = (unit @ unit.T >= least) & ~np.eye(len(ids), dtype=bool)
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in zip(*np.nonzero(near), strict=True):
        a, b = sorted((find(ids[a]), find(ids[b])))
        up[b] = a
    links = dict(zip(ids, near.sum(axis=1).tolist(), strict=True))
    return sorted(
        (i, links.get(i, 0), find(i), find(i) == i) if i is not None else (-1, 0, None, False)
        for i, _ in rows
    )


@pytest.mark.parametrize("per_group", [2048, 20])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, per_group):
    monkeypatch.setattr(pq_dedup, "PER_GROUP", per_group)
    rows = noisy(600)
    got = pq_dedup.near_duplicates(table(spark, rows), spread=99.0).collect()
    have = sorted((-1 if r.vec_id is None else r.vec_id, *tuple(r)[1:]) for r in got)
    assert have == plain_groups(rows)


def test_the_usual_probes_miss_few_links(spark):
    rows = noisy(600, seed=2)
    got = pq_dedup.near_duplicates(table(spark, rows)).collect()
    want = sum(r[1] for r in plain_groups(rows))
    assert want * 0.98 <= sum(r.n_links for r in got) <= want


def test_repeats_and_empty(spark):
    rows = [(7, [1.0] * 8), (7, [1.0] * 8), (3, [2.0] * 8), (9, [1.0, -1.0] * 4), (9, [1.0] * 8)]
    got = sorted(map(tuple, pq_dedup.near_duplicates(table(spark, rows)).distinct().collect()))
    assert [(r[0], r[2], r[3]) for r in got] == [(3, 3, True), (7, 3, False), (9, 3, False)]
    assert pq_dedup.near_duplicates(table(spark, [])).count() == 0
    only_bad = pq_dedup.near_duplicates(table(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(map(tuple, only_bad)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_codes_bound_distances():
    rng = np.random.default_rng(0)
    v = rng.standard_normal((500, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    book = pq_dedup.Quantizer.fit(v[:300], 9)
    lists = ((v[:, None] - book.centres[None]) ** 2).sum(2).argmin(1)
    codes, error = book.encode(v, lists)
    for one in range(len(book.centres)):
        held = lists == one
        rough = np.sqrt(book.distances(v[:20], one, codes[held]))
        true = np.linalg.norm(v[:20, None] - v[held][None], axis=2)
        assert (np.abs(rough - true) <= error[held][None] + 1e-9).all()


def test_no_near_pair_is_dropped_by_half_the_codes():
    rng = np.random.default_rng(5)
    v = rng.standard_normal((1500, 64))
    v[1000:] = v[:500] + 0.15 * rng.standard_normal((500, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    book = pq_dedup.Quantizer.fit(v[:1200], 3)
    lists = ((v[:, None] - book.centres[None]) ** 2).sum(2).argmin(1)
    codes, error = book.encode(v, lists)
    for one in range(len(book.centres)):
        held = np.flatnonzero(lists == one)
        i, j = book.within(v, one, codes[held], 0.3 + error[held])
        rough = np.sqrt(book.distances(v, one, codes[held]))
        kept = np.zeros_like(rough, dtype=bool)
        kept[i, j] = True
        assert len(i) == kept.sum()  # each pair once
        assert (kept >= (rough <= 0.3 + error[held])).all()
        assert (kept <= (rough <= 0.3 + error[held] + 1e-3)).all()
        assert kept[np.linalg.norm(v[:, None] - v[held][None], axis=2) <= 0.3].all()
        assert kept.sum() < 0.02 * kept.size


def test_lists_keep_their_size_when_rows_grow(spark, monkeypatch):
    asked = []
    fit = pq_dedup.Quantizer.fit
    monkeypatch.setattr(pq_dedup, "PER_GROUP", 40)
    monkeypatch.setattr(
        pq_dedup.Quantizer, "fit", lambda sample, lists: asked.append(lists) or fit(sample, lists)
    )
    for n in (200, 1000):
        rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(n).standard_normal((n, 8)))]
        got = pq_dedup.near_duplicates(table(spark, rows), spread=99.0).collect()
        assert sorted(map(tuple, got)) == plain_groups(rows)
    assert asked[1] >= 4 * asked[0]  # lists hold as many as before, not more with more rows


def plain_search(rows, every, k=5):
    ids, unit = good(rows)
    out = {}
    for q, i in enumerate(ids):
        if i % every == 0:
            ranked = sorted((-round(float(unit[q] @ unit[j]), 12), ids[j]) for j in range(len(ids)) if ids[j] != i)
            out[i] = [(j, -s) for s, j in ranked[:k]]
    return out


@pytest.mark.parametrize("share,least", [(1.0, 0.97), (0.6, 0.9)])
def test_search_finds_the_nearest(spark, share, least):
    rows = noisy(900, seed=4)
    got = {}
    for r in ann_search.search(table(spark, rows), every=10, share=share).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = plain_search(rows, 10)
    assert set(got) == set(want)
    hit = 0
    for q, ranked in want.items():
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        scores = [got[q][r][1] for r in (1, 2, 3, 4, 5)]
        assert scores == sorted(scores, reverse=True)
        hit += len({j for j, _ in ranked} & {j for j, _ in got[q].values()})
    assert hit >= least * sum(map(len, want.values()))


def test_search_of_few_and_equal_vectors(spark):
    rows = [(0, [1.0] * 8), (1, [2.0] * 8), (2, [1.0] * 8), (3, [1.0, -1.0] * 4), (4, None)]
    got = sorted(map(tuple, ann_search.search(table(spark, rows)).collect()))
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert ann_search.search(table(spark, [])).count() == 0
    many = [(i, [1.0] * 8) for i in range(300)]
    got = sorted(map(tuple, ann_search.search(table(spark, many), every=100).collect()))
    assert [g[2] for g in got if g[0] == 0] == [1, 2, 3, 4, 5]
    assert [g[2] for g in got if g[0] == 200] == [0, 1, 2, 3, 4]


def test_a_row_is_abandoned_only_if_it_is_farther():
    rng = np.random.default_rng(3)
    points = rng.standard_normal((2000, 64))
    blocks = [points[:, a : a + 8] for a in range(0, 64, 8)]
    kept = found = 0
    for q in rng.standard_normal((30, 64)):
        rows = ann_search.scan(blocks, q, 5)
        best = np.argsort(((points - q) ** 2).sum(1))[:5]
        found += len(set(best) & set(rows))
        kept += len(rows)
    assert found >= 0.97 * 150 and kept < 0.2 * 30 * 2000


def test_queries_on_the_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    v = np.array([r[1] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = np.array([r[0] for r in rows])
    hit = total = 0
    got = queries.op6_ann_search(spark, sf).toPandas()
    for q in np.flatnonzero(ids % 50 == 0):
        s = v @ v[q]
        s[q] = -9
        mine = got[got.query_id == ids[q]]
        assert np.allclose(mine.score, s[[int(np.flatnonzero(ids == i)[0]) for i in mine.vec_id]])
        hit += len(set(ids[np.argsort(-s)[:5]]) & set(mine.vec_id))
        total += 5
    assert hit >= 0.9 * total
    near = (v @ v.T >= 0.95).sum(1) - 1
    links = queries.op7_vector_groups(spark, sf).toPandas().set_index("vec_id").n_links
    assert abs(links.loc[ids].to_numpy() - near).sum() <= 0.02 * max(1, near.sum())
