"""Scores by the difference of cross-entropies under a target and a background language model.

Both are bigram models over one vocabulary: the words of all documents. Words and pairs are known by
64-bit hashes and counted exactly, so the counts grow with the corpus. Documents lie in blocks; a
block sends each of its distinct n-grams once, to the shard that counts it over all blocks, and gets
the counts back in the same order.
"""

from __future__ import annotations

import gc
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from xxhash import xxh64_intdigest

from rillhouse.llm.common import lookup, stored, tidy

#: Words that the even distribution is made for, at least; a larger vocabulary has its own size.
WORDS = 1 << 18
#: Weight of the word model in the pair model, and of the even distribution in the word model.
PRIOR, FLOOR = 20.0, 0.5
#: Bytes of text of one block of documents, and for each shard of the counts (no effect on results).
BLOCK, SHARD = 6 << 20, 4 << 20
#: Counts are stored in row groups of about so many bytes, which are several times as many in memory.
GROUP_BYTES = 2 << 20


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a text's words, of the words before them, and of the pairs; 0 begins a text."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(xxh64_intdigest, words, repeat(1)), dtype="<u8", count=len(words))
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]]) if len(h) else h
    pair = before * np.uint64(0x9E3779B97F4A7C15) + h
    pair ^= pair >> np.uint64(29)
    pair *= np.uint64(0xBF58476D1CE4E5B9)
    return h, before, pair


#: The name of earlier versions, which counted by buckets of these hashes.
buckets = ngrams


def keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams of some texts, a row each for words, firsts of pairs and pairs.

    Only those of words are odd. Also the number of words of each text.
    """
    found = [ngrams(t) for t in texts]
    word, first, pair = (np.concatenate([f[k] for f in found]) for k in range(3))
    first = (first ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xFF51AFD7ED558CCD)
    rows = np.stack([word | np.uint64(1), first & ~np.uint64(1), pair & ~np.uint64(1)])
    return rows, np.array([len(f[0]) for f in found], dtype=np.int64)


def pack(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then the second ones: shuffles compress that."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpack(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def blocked(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` with ``_block`` and the ``_row`` in it: about ``size`` bytes of text of one task."""

    def run(batches):
        task, seen, block, row = TaskContext.get().partitionId() << 32, 0, -1, 0
        for batch in batches:
            blocks, places = [], []
            for text in pa.compute.binary_length(batch.column("text")).to_pylist():
                at = task + seen // size
                block, row = at, row + 1 if at == block else 0
                blocks.append(at)
                places.append(row)
                seen += text or 0
            more = batch.append_column("_block", pa.array(blocks, pa.int64()))
            yield more.append_column("_row", pa.array(places, pa.int64()))

    added = [StructField("_block", LongType()), StructField("_row", LongType())]
    schema = StructType([*docs.schema.fields, *added])
    # the copy of the texts lies there to the end
    return stored(docs.mapInArrow(tidy(run), schema), "lm-blocks", "zstd")


def shared_counts(docs: DataFrame, shards: int) -> DataFrame:
    """``(block, row, shard, target, background)`` with counts over all documents, and sums.

    ``docs`` are ``blocked``, with ``_target``. A piece is what one task reads of a block, from
    ``row`` on. The counts of a piece are those of its distinct keys in order; they are cut into
    ``shards`` ranges of keys. Rows without a block have the number of distinct ``words`` of a shard
    and the sums of their counts, ``n_target`` and ``n_background``.
    """
    borders = np.array([(k << 64) // shards for k in range(shards)], dtype=np.uint64)

    def sent(block, row, texts, marks):
        rows, n = keys(texts)
        marked = rows[:, np.repeat([bool(m) for m in marks], n)].ravel()
        distinct, every = np.unique(rows.ravel(), return_counts=True)
        some, times = np.unique(marked, return_counts=True)
        target = np.zeros(len(distinct), dtype="<u4")
        target[np.searchsorted(distinct, some)] = times
        every = every.astype("<u4")
        cuts = [*np.searchsorted(distinct, borders).tolist(), len(distinct)]
        spans = [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        steps = [np.diff(distinct[a:b], prepend=borders[k]) for k, a, b in spans]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in spans], pa.int32()),
                pa.array([block] * len(spans), pa.int64()),
                pa.array([row] * len(spans), pa.int64()),
                pa.array([pack(v) for v in steps], pa.binary()),
                pa.array([pack(target[a:b]) for _, a, b in spans], pa.binary()),
                pa.array([pack(every[a:b]) for _, a, b in spans], pa.binary()),
            ],
            ["shard", "block", "row", "steps", "target", "background"],
        )

    def count(batches):
        block, start, texts, marks = None, 0, [], []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_block", "_row", "text", "_target"))
            for at, row, text, mark in zip(*columns, strict=True):
                if at != block or row != start + len(texts):
                    if texts:
                        yield sent(block, start, texts, marks)
                    block, start, texts, marks = at, row, [], []
                texts.append(text)
                marks.append(mark)
        if texts:
            yield sent(block, start, texts, marks)

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        steps = [unpack(v, "<u8") for v in rows.column("steps").to_pylist()]
        ends = np.cumsum([len(v) for v in steps])
        shard = key[0].as_py()
        own = np.concatenate([np.cumsum(v, dtype=np.uint64) + borders[shard] for v in steps])
        del steps
        distinct, at = np.unique(own, return_inverse=True)
        word = (distinct & np.uint64(1)) == 1
        out, sums = {}, {}
        for name in ("target", "background"):
            n = np.concatenate([unpack(v, "<u4") for v in rows.column(name).to_pylist()])
            # whole numbers below 2^53 are exact as weights
            total = np.bincount(at, n, len(distinct)).astype("<i8")
            out[name] = [pack(v) for v in np.split(total[at], ends[:-1])]
            sums[name] = int(total[word].sum())
        none = [None] * len(rows)
        return pa.table({
            **{c: pa.array([*rows.column(c).to_pylist(), None], pa.int64()) for c in ("block", "row")},
            "shard": pa.array([*[shard] * len(rows), shard], pa.int32()),
            **{c: pa.array([*v, None], pa.binary()) for c, v in out.items()},
            "words": pa.array([*none, int(word.sum())], pa.int64()),
            "n_target": pa.array([*none, sums["target"]], pa.int64()),
            "n_background": pa.array([*none, sums["background"]], pa.int64()),
        })

    counted = docs.select("_block", "_row", "text", "_target").mapInArrow(
        tidy(count),
        "shard int, block long, row long, steps binary, target binary, background binary",
    )
    added = counted.groupBy("shard").applyInArrow(
        add,
        "block long, row long, shard int, target binary, background binary, words long, "
        "n_target long, n_background long",
    )
    return stored(added, "lm-counts", "zstd", GROUP_BYTES)


def forget(docs: DataFrame) -> None:
    """Files of shuffles that are over go once the driver has collected its garbage."""
    gc.collect()
    docs.sparkSession.sparkContext._jvm.System.gc()


def log_probabilities(word, first, pair, total: int, words: int) -> np.ndarray:
    """By the counts of words, of the words before them as firsts, and of the pairs."""
    single = (word + FLOOR) / (total + FLOOR * words)
    return np.log((pair + PRIOR * single) / (first + PRIOR))


def score(docs: DataFrame, targets: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ce_target``, ``ce_background`` and ``score``.

    ``targets(doc_id)`` names the documents of the target domain; counts cover all documents. Cross-
    entropies are nats per word, and the score is that of the target less that of the background:
    the lower, the closer to the target. Texts without a word, and null, have zeros. Without any
    target document the target model knows nothing and is the same for all words. Columns of the
    input with these names are replaced; rows without an id are background.
    """
    made = ["n_tokens", "ce_target", "ce_background", "score"]
    plain = docs.drop(*made, "target")
    marks = targets.where("doc_id is not null").select("doc_id").distinct()
    marks = stored(marks.withColumn("_target", F.lit(True)), "lm-targets")
    rows = blocked(lookup(plain, marks, "doc_id"), block)
    forget(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = shared_counts(rows, size // shard + 1)
    words, *totals = (
        v or 0 for v in counts.agg(F.sum("words"), F.sum("n_target"), F.sum("n_background")).first()
    )
    words = max(words, WORDS)
    forget(docs)
    columns = plain.columns

    def run(own: pa.Table, shared: pa.Table) -> pa.Table:
        own, shared = own.sort_by("_row"), shared.sort_by([("row", "ascending"), ("shard", "ascending")])
        texts = own.column("text").to_pylist()
        n = np.zeros(len(texts), dtype=np.int64)
        means = np.zeros((2, len(texts)))
        row = shared.column("row").to_numpy()
        # documents before the first piece, and pieces without counts, have no words
        starts = np.unique(row)
        first = np.searchsorted(own.column("_row").to_numpy(), starts).tolist()
        for start, a, b in zip(starts, first, [*first, len(texts)][1:], strict=True):
            rows, n[a:b] = keys(texts[a:b])
            distinct, at = np.unique(rows.ravel(), return_inverse=True)
            at = at.reshape(rows.shape)
            text = np.repeat(np.arange(b - a), n[a:b])
            piece = shared.filter(pa.array(row == start))
            for k, name in enumerate(("target", "background")):
                counts = np.concatenate([unpack(v, "<i8") for v in piece.column(name).to_pylist()])
                if len(counts) != len(distinct):
                    raise ValueError(f"counts of {len(counts)} keys met {len(distinct)}")
                logs = log_probabilities(*counts[at].astype(np.float64), totals[k], words)
                means[k, a:b] = -np.bincount(text, logs, b - a) / np.maximum(n[a:b], 1) + 0.0
        kept = own.select(columns)
        for name, v in zip(made, (n, *means, means[0] - means[1]), strict=True):
            kept = kept.append_column(name, pa.array(v))
        return kept

    kinds = [LongType(), DoubleType(), DoubleType(), DoubleType()]
    schema = [*plain.schema.fields, *(StructField(c, k) for c, k in zip(made, kinds, strict=True))]
    told = counts.where("block is not null").select("block", "row", "shard", "target", "background")
    return rows.groupBy("_block").cogroup(told.groupBy("block")).applyInArrow(run, StructType(schema))
