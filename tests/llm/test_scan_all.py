"""Queries of a group scanned together."""

import numpy as np

from rillhouse.llm import ann_search


def test_queries_together_keep_what_each_keeps_and_its_nearest():
    rng = np.random.default_rng(3)
    rows, queries = rng.standard_normal((500, 32)), rng.standard_normal((20, 32))
    queries[0] = rows[499]
    blocks = [rows[:, a : a + 8] for a in range(0, 32, 8)]
    q, r = ann_search.scan_all(blocks, queries, 5)
    for i, query in enumerate(queries):
        assert r[q == i].tolist() == ann_search.scan(blocks, query, 5).tolist()
    distance = ((queries[:, None] - rows) ** 2).sum(axis=2)
    nearest = np.argsort(distance, axis=1)[:, :5]
    kept = sum(len(np.intersect1d(nearest[i], r[q == i])) for i in range(20))
    assert kept >= 95 and len(q) < 0.5 * 20 * 500
    few = ann_search.scan_all([b[:3] for b in blocks], queries, 5)
    assert len(few[0]) == 60
