"""A toxicity classifier that is held to score alike when identity terms are swapped.

Features are hashed words and word beginnings that a whole text holds. The log loss over labelled
texts is joined by a penalty on the squared change of the margin between a text and its
counterfactual, in which every identity term is replaced by the next term of its list. A group that
is merely mentioned more often in toxic texts so gets no weight of its own.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import stored, tidy

#: Lists of terms that stand for each other in a neutral sentence (fixed values, a parameter).
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "transgender", "nonbinary"),
    ("woman", "man"),
    ("female", "male"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "american"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "old", "young"),
)
#: The model is fit on so many labelled texts at most: those whose ids have the smallest hashes.
SAMPLE_ROWS = 30_000
#: Hash space of the features, and how many with the clearest difference enter the model.
BUCKETS, SELECTED = 1 << 20, 3000
BEGINNINGS = (4, 5, 6, 7)

_words = re.compile(r"[^\W_]+").findall


def swaps(terms: tuple[tuple[str, ...], ...]) -> dict[str, str]:
    """Each term to the next of its list; the last to the first."""
    return {t: row[(k + 1) % len(row)] for row in terms for k, t in enumerate(row)}


def word_buckets(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    raw = [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)]
    return [zlib.crc32(w.encode()) % BUCKETS for w in raw]


def text_buckets(words: set[str]) -> np.ndarray:
    return np.unique(np.array([b for w in words for b in word_buckets(w)], dtype=np.int64))


def word_set(text: str | None) -> set[str]:
    return set(_words((text or "").lower()))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that lend no label: crc32 of the id as text, modulo 3, is 1. A null id is not such."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """``(text, toxic)`` of a bounded sample of labelled texts outside the held-out fold."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = (
        known.where("id is not null and toxic is not null")
        .where(~held_out("id"))
        .orderBy(F.xxhash64("id"), "id", "toxic")
        .limit(limit)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    return stored(texts.select("text", "toxic"), "toxicity-sample")


def select_features(sample: DataFrame, n_toxic: int, n_clean: int, limit: int) -> np.ndarray:
    """The buckets whose rates among toxic and clean texts differ most, in standard errors."""

    def count(batches):
        sums = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[toxic, text_buckets(word_set(text))] += 1
        seen = np.flatnonzero(sums.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(sums[1, seen]), pa.array(sums[0, seen])],
            ["bucket", "toxic", "clean"],
        )

    counts = (
        sample.mapInArrow(count, "bucket long, toxic long, clean long")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        .where(F.col("t") + F.col("c") >= 3)
    )
    p = (F.col("t") + F.col("c")) / F.lit(float(n_toxic + n_clean))
    gap = F.col("t") / F.lit(float(max(1, n_toxic))) - F.col("c") / F.lit(float(max(1, n_clean)))
    error = F.sqrt(p * (1 - p) * F.lit(1 / max(1, n_toxic) + 1 / max(1, n_clean)) + F.lit(1e-12))
    clear = counts.select("bucket", F.abs(gap / error).alias("z")).where("z > 3")
    return np.array(
        sorted(r[0] for r in clear.orderBy(F.desc("z"), "bucket").limit(limit).collect()),
        dtype=np.int64,
    )


def fit(
    rows: list[np.ndarray],
    swapped: list[np.ndarray | None],
    labels: np.ndarray,
    n_features: int,
    fairness: float,
    ridge: float = 5e-5,
    steps: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam over all rows at once."""
    here = [k for k, s in enumerate(swapped) if s is not None]
    at, cols = _flat(rows)
    pair_at, pair_cols = _flat([rows[k] for k in here])
    swap_at, swap_cols = _flat([swapped[k] for k in here])
    n = max(1, len(rows))
    rate = np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3)
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(rate / (1 - rate))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w = theta[:-1]
        margin = np.bincount(at, w[cols], len(rows)) + theta[-1]
        slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / n
        grad = np.append(np.bincount(cols, slope[at], n_features) + ridge * w, slope.sum())
        if here:
            moved = np.bincount(pair_at, w[pair_cols], len(here)) - np.bincount(
                swap_at, w[swap_cols], len(here)
            )
            pull = 2 * fairness * moved / len(here)
            grad[:-1] += np.bincount(pair_cols, pull[pair_at], n_features)
            grad[:-1] -= np.bincount(swap_cols, pull[swap_at], n_features)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(r) for r in rows]
    cols = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    return np.repeat(np.arange(len(rows)), sizes), cols


@dataclass
class Model:
    """Weights of the selected buckets; a word's buckets are looked up once per worker."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        self.place = {int(b): k for k, b in enumerate(self.buckets)}
        self.words: dict[str, tuple[int, ...]] = {}

    def features(self, words: set[str]) -> set[int]:
        if len(self.words) > 100_000:
            self.words.clear()
        found, known, place = set(), self.words, self.place
        for word in words:
            mine = known.get(word)
            if mine is None:
                mine = tuple(place[b] for b in word_buckets(word) if b in place)
                known[word] = mine
            if mine:
                found.update(mine)
        return found

    def score(self, text: str | None) -> float:
        margin = self.intercept + sum(self.weights[k] for k in sorted(self.features(word_set(text))))
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    fairness: float = 1.0,
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on a bounded sample. Without labels of both kinds the score is the same for all texts.

    What the driver gets is bounded by parameters: the selected buckets, and per sampled text
    those of them that it holds.
    """
    sample = labelled(docs, labels, sample_rows)
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(np.empty(0, np.int64), np.empty(0), 4.0 if sizes.get(1) else -4.0)
    buckets = select_features(sample, sizes[1], sizes[0], SELECTED)
    other = swaps(terms)

    def features(batches):
        model = Model(buckets, np.zeros(len(buckets)), 0.0)
        for batch in batches:
            texts, toxic = (batch.column(c).to_pylist() for c in ("text", "toxic"))
            sets = [word_set(t) for t in texts]
            turned = [{other.get(w, w) for w in s} if s & other.keys() else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(toxic, pa.int32()),
                    pa.array([sorted(model.features(s)) for s in sets], pa.list_(pa.int32())),
                    pa.array(
                        [None if s is None else sorted(model.features(s)) for s in turned],
                        pa.list_(pa.int32()),
                    ),
                ],
                ["toxic", "found", "swapped"],
            )

    schema = "toxic int, found array<int>, swapped array<int>"
    got = sorted(map(tuple, sample.mapInArrow(features, schema).collect()), key=str)
    weights, intercept = fit(
        [np.array(r[1], np.int64) for r in got],
        [None if r[2] is None else np.array(r[2], np.int64) for r in got],
        np.array([r[0] for r in got], dtype=float),
        len(buckets),
        fairness,
    )
    return Model(buckets, weights, intercept)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of the whole text; null and empty texts get that of no feature.

    A column of that name is replaced; nothing but the text enters.
    """
    buckets, weights, intercept = model.buckets, model.weights, model.intercept

    def run(batches):
        mine = Model(buckets, weights, intercept)
        for batch in batches:
            marks = [mine.score(t.as_py()) for t in batch.column("text")]
            yield batch.append_column(column, pa.array(marks, pa.float64()))

    plain = docs.drop(column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(tidy(run), f"{schema}, `{column}` double")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    scored = score(docs, train(docs, labels), "_toxicity")
    return scored.where(F.col("_toxicity") < threshold).select(*docs.columns)
