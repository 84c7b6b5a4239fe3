"""Nearest neighbours by inverted lists whose rows are compared a few dimensions at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import stored
from rillhouse.llm.vectors import (
    cluster, cosines, list_count, matrix, sampled, squared, units, usable,
)

#: Share of the lists that a query probes, dimensions per block, and the width of the test.
PROBED, BLOCK, WIDTH = 0.8, 8, 2.1
#: Index rows that one group holds at most, about.
PER_GROUP = 4096
#: Pairs of a query and a row that are compared at once.
PAIRS = 1 << 19


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix: after it, any block of dimensions stands for all."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def scan(blocks: list[np.ndarray], query: np.ndarray, k: int, width: float = WIDTH) -> np.ndarray:
    """Rows that may be among the ``k`` nearest to ``query``, from column ``blocks``."""
    return scan_all(blocks, query[None], k, width)[1]


def scan_all(
    blocks: list[np.ndarray], queries: np.ndarray, k: int, width: float = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row that may be among its ``k`` nearest, from column ``blocks``.

    A query's ``k``-th distance over the first rows is its bar. After each block of dimensions a
    pair's partial squared distance, scaled to all dimensions, is tested against the bar: if it is
    larger by more than chance allows at this many dimensions, the pair is abandoned. Many pairs are
    compared as a product of matrices, the few that are left one by one.
    """
    n, dims = len(blocks[0]), queries.shape[1]
    ends = np.cumsum([b.shape[1] for b in blocks])
    asked = np.split(queries, ends[:-1], axis=1)
    first = min(n, max(8 * k, 64))
    q, r = (v.ravel() for v in np.indices((len(queries), n)))
    if first <= k:
        return q, r
    full = sum(squared(a, b[:first]) for a, b in zip(asked, blocks, strict=True))
    bar = np.partition(full, k - 1, axis=1)[:, k - 1]
    partial = np.zeros(len(q))
    for a, block, at in zip(asked, blocks, ends.tolist(), strict=True):
        if 8 * len(q) > len(queries) * n:
            partial = partial + squared(a, block)[q, r]
        else:
            part = block[r] - a[q]
            partial = partial + (part * part).sum(axis=1)
        slack = (1 + width / np.sqrt(at)) ** 2 if at < dims else 1 + 1e-9
        stay = partial <= (bar * (at / dims) * slack)[q] + 1e-12
        q, r, partial = q[stay], r[stay], partial[stay]
    return q, r


def probes(vectors: np.ndarray, centres: np.ndarray, sizes: np.ndarray, k: int, share: float):
    """Per row the lists to probe: the nearest share of lists, and on until they hold enough."""
    order = np.argsort(squared(vectors, centres), axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    enough = (held <= k).sum(axis=1) + 1
    count = np.maximum(int(np.ceil(share * len(centres))), enough)
    return [row[:n] for row, n in zip(order, count, strict=True)]


def search(
    vectors: DataFrame, every: int = 50, k: int = 5, share: float = PROBED
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query by cosine.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all other rows.
    Lists are fit on a bounded sample and hold every row; large ones are split, and a query goes to
    each part. Equal scores go to the smaller ``vec_id``. Vectors that cannot be compared take no
    part; repeated ids are rows of their own, but a query never finds its own id.
    """
    rows = stored(usable(vectors), "ann-rows")
    spark, n = rows.sparkSession, rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if n == 0:
        return spark.createDataFrame([], schema)
    sample = sampled(rows)
    centres = cluster(sample, list_count(n))
    turn = rotation(sample.shape[1])

    def assign(frames):
        for frame in frames:
            if len(frame):
                near = squared(units(matrix(frame["vector"])), centres).argmin(axis=1)
                yield frame.assign(list=near.astype(np.int32))

    listed = "vec_id long, vector array<double>, list int"
    indexed = stored(rows.mapInPandas(assign, listed), "ann-lists")
    sizes = np.zeros(len(centres), dtype=np.int64)
    for r in indexed.groupBy("list").count().collect():
        sizes[r[0]] = r[1]
    parts = (sizes // PER_GROUP + 1).astype(int)

    def deal(frames):
        for frame in frames:
            if not len(frame):
                continue
            v = units(matrix(frame["vector"]))
            out = []
            chosen = probes(v, centres, sizes, k, share)
            for q, lists in enumerate(chosen):
                for one in lists:
                    out.extend((q, int(one), p) for p in range(parts[one]))
            got = np.array(out)
            yield pd.DataFrame({
                "list": got[:, 1].astype(np.int32), "part": got[:, 2].astype(np.int32),
                "vec_id": frame["vec_id"].to_numpy()[got[:, 0]],
                "vector": frame["vector"].to_numpy()[got[:, 0]],
            })

    group = "list int, part int, vec_id long, vector array<double>"
    asked = indexed.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    asked = asked.distinct().mapInPandas(deal, group)
    per_list = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("list") + 1)
    part = F.pmod(F.xxhash64("vec_id", "vector"), per_list).cast("int").alias("part")
    held = indexed.select("list", part, "vec_id", "vector")

    def nearest(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(index) and len(queries):
            index = index.sort_values("vec_id", kind="stable")
            own, raw = index["vec_id"].to_numpy(), matrix(index["vector"])
            turned = units(raw) @ turn
            edges = range(0, turned.shape[1], BLOCK)
            blocks = [np.ascontiguousarray(turned[:, a : a + BLOCK]) for a in edges]
            asked_raw = matrix(queries["vector"])
            asked_turned = units(asked_raw) @ turn
            asked_ids = queries["vec_id"].to_numpy()
            step = max(1, PAIRS // len(own))
            for at in range(0, len(asked_ids), step):
                q, r = scan_all(blocks, asked_turned[at : at + step], k + 1)
                q = q + at
                other = own[r] != asked_ids[q]
                q, r = q[other], r[other]
                score = cosines(raw[r], asked_raw[q])
                order = np.lexsort((own[r], -score, q))
                q, r, score = q[order], r[order], score[order]
                best = np.arange(len(q)) - np.searchsorted(q, q) < k
                found.append((asked_ids[q][best], own[r][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    pairs = held.groupBy("list", "part").cogroup(asked.groupBy("list", "part")).applyInPandas(
        nearest, "query_id long, vec_id long, score double"
    )
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
