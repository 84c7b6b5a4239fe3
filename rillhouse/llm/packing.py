"""Packing of documents into sequences by best fit with matching of large items."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import row_bytes, sized, stored, tidy
from rillhouse.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length int, ids binary"
#: About so many pieces of one length are numbered by one task.
PER_TASK = 20_000


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``; ids are little-endian unsigned 32-bit numbers.

    A document is its ids and ``end_id``. Longer ones than ``capacity`` are cut so that all pieces
    but the first are full. A null or empty text is its end alone; ids may be null or repeat.
    """

    def run(batches):
        encode = encoder(tokenizer, True).encode
        for batch in batches:
            texts, names = batch.column("text"), batch.column("doc_id").to_pylist()
            rows, size = [], 0
            for name, text in zip(names, texts, strict=True):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((name, k, a, b - a, ids[a:b].tobytes()))
                size += 4 * len(ids)
                if size > 16 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run), PIECES)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["doc_id", "piece", "start", "length", "ids"],
    )


def plan(counts: dict[int, int], capacity: int = 1024) -> dict[int, list[tuple[int, ...]]]:
    """Where the pieces of each length go: runs ``(rank, sequence, per_sequence, offset)``.

    Pieces are known here by length and rank among those of the length only, so the plan is made
    from at most ``capacity`` counts, whatever the corpus holds. Lengths above a third of the
    capacity fit twice into a sequence at most: from the longest down, each is matched with the
    longest that fits beside it. Then the shorter lengths, from the longest down, go to the
    smallest gap that holds them; what fits nowhere opens sequences. A run tells that from ``rank``
    on, pieces fill the sequences from ``sequence`` on, ``per_sequence`` into each from ``offset``.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    runs: dict[int, list[tuple[int, ...]]] = {k: [] for k in left}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: spans of sequences, all filled alike
    sizes: list[int] = []
    opened = 0

    def place(size: int, n: int, sequence: int, per: int, offset: int) -> None:
        runs[size].append((used[size], sequence, per, offset))
        used[size] += n
        left[size] -= n

    def leave(gap: int, begin: int, end: int) -> None:
        if gap > 0 and end > begin:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((begin, end))

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        size = large[-1]
        beside = [k for k in large if k <= capacity - size and (k < size or left[size] > 1)]
        if not beside:
            n = left[size]
            place(size, n, opened, 1, 0)
            leave(capacity - size, opened, opened + n)
        elif beside[-1] == size:
            n = left[size] // 2
            place(size, 2 * n, opened, 2, 0)
            leave(capacity - 2 * size, opened, opened + n)
        else:
            n = min(left[size], left[beside[-1]])
            place(size, n, opened, 1, 0)
            place(beside[-1], n, opened, 1, size)
            leave(capacity - size - beside[-1], opened, opened + n)
        opened += n
        large = [k for k in large if left[k] > 0]

    for size in sorted((k for k in left if left[k] > 0), reverse=True):
        while left[size] > 0:
            at = bisect_left(sizes, size)
            if at == len(sizes):
                gap, begin = capacity, opened
                end = begin + -(-left[size] // (capacity // size))
                opened = end
            else:
                gap = sizes[at]
                begin, end = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            per = gap // size
            need = min(end - begin, -(-left[size] // per))
            if begin + need < end:
                leave(gap, begin + need, end)
            n = min(left[size], need * per)
            full, rest = divmod(n, per)
            place(size, n, begin, per, capacity - gap)
            leave(gap - per * size, begin, begin + full)
            if rest:
                leave(gap - rest * size, begin + full, begin + full + 1)
    return runs


def place(cut: DataFrame, capacity: int = 1024) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset``; what else they carry is kept.

    Ranks of a length are numbered per (length, salt) and shifted by the counts of the salts
    before, so a length that a third of all pieces have is spread over tasks. Rows are shuffled
    once; a caller that needs no ids drops them before.
    """
    salts = cut.count() // PER_TASK + 1
    kept = cut.columns
    salted = cut.withColumn(
        "_salt", F.pmod(F.xxhash64(*sorted(kept)), F.lit(salts)).cast("int")
    )
    counts = stored(salted.groupBy("length", "_salt").agg(F.count("*").alias("n")), "pack-counts")
    lengths = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(
        "length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift")
    )
    order = W.partitionBy("length", "_salt").orderBy("doc_id", "piece", F.xxhash64(*sorted(kept)))
    ranked = salted.withColumn("_rank", F.row_number().over(order) - 1).join(
        sized(shifts, counts.count() * row_bytes(counts)), ["length", "_salt"]
    )
    runs = {k: np.array(v, dtype=np.int64) for k, v in plan(lengths, capacity).items()}

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                mine = runs[int(size)]
                r = mine[np.searchsorted(mine[:, 0], rank[rows], side="right") - 1]
                turn, slot = np.divmod(rank[rows] - r[:, 0], r[:, 2])
                sequence[rows] = r[:, 1] + turn
                offset[rows] = r[:, 3] + slot * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"],
            )

    slim = ranked.select(*kept, (F.col("_rank") + F.col("_shift")).alias("_rank"))
    schema = ", ".join(f"`{c}` {kind}" for c, kind in cut.dtypes)
    return slim.mapInArrow(tidy(run), f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """The pieces of all documents, ids included, with ``sequence_id`` and ``offset``.

    Repeated documents are packed as often as they come; an empty table gives an empty result.
    """
    return place(stored(pieces(docs, tokenizer, end_id, capacity), "pack-pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences, each of one capacity at most."""

    def joined(key, group):
        whole = b"".join(group.sort_values("offset")["ids"])
        return group.iloc[:1][["sequence_id"]].assign(ids=whole)

    rows = packed.select("sequence_id", "offset", "ids")
    return rows.groupBy("sequence_id").applyInPandas(joined, "sequence_id long, ids binary")
