"""Helpers for vectors: which take part, bounded samples, clustering."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What is fit is fit on so many vectors at most: those with the smallest hashes.
SAMPLE = 20_000


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the vectors that can be compared: as doubles.

    Not null, without null or non-finite components, not zero, and of the most frequent length
    (of several, the smallest): cosines between lengths do not exist.
    """
    v = F.col("vector")
    rows = vectors.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("vector"),
    )
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0.0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count()
    most = sizes.orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (most[0] if most else 0))


def sampled(rows: DataFrame, limit: int = SAMPLE) -> np.ndarray:
    """Unit vectors of a bounded sample, as a matrix on the driver."""
    picked = rows.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(limit)
    got = np.array([r[0] for r in picked.select("vector").toLocalIterator()], dtype=np.float64)
    return units(got) if len(got) else np.zeros((0, 1))


def units(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), dtype=np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; the same rows give the same number anywhere."""
    return (units(a) * units(b)).sum(axis=1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between all rows of two small matrices."""
    d = (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :]
    return np.maximum(d, 0)


def cluster(points: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Centres by Lloyd's rounds from a seeded choice; at most as many as distinct points."""
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds if len(points) > k else 0):
        near = squared(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        some = counts > 0
        centres[some] = sums[some] / counts[some, None]
    return centres


def list_count(n: int, most: int = 4096) -> int:
    """How many lists: about the root of the rows, bounded so that centres stay small."""
    return int(min(most, max(1, round(n**0.5))))
