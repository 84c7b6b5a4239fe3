"""Hard negatives: for each anchor and positive, the best others in a window below its score."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import stored, tidy

#: About so many vector components make up a block of rows, and of anchors.
ROW_VALUES, ANCHOR_VALUES = 1 << 19, 1 << 18
#: Rows of a block that are compared at once.
CHUNK = 1024
_MOST, _LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min  # no score is the least


def quantised(vectors: DataFrame, column: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that take part, components as whole numbers.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part;
    zero and empty vectors do. A component beyond 64 bits becomes the nearest 64-bit number. Of
    rows that repeat an id one counts, the smallest by label and vector.
    """
    v = F.col("vector")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col(column).cast("array<double>").alias("vector"),
    ).where("vec_id is not null and label is not null and vector is not null")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * scale)).cast("array<long>")
    rows = rows.where(~F.coalesce(bad, F.lit(False))).withColumn("vector", whole)
    once = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return once.select("vec_id", "row.label", "row.vector")


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two integer matrices, exactly; beyond 64 bits the nearest number."""
    top = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    bound = top[0] * top[1] * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, int(_LEAST) + 1, int(_MOST)).astype(np.int64)


def best_of_slots(
    anchors: pd.DataFrame, rows: pd.DataFrame, k: int, same_label: bool
) -> pd.DataFrame:
    """The ``k`` best rows of every slot of every anchor, of one block of anchors and one of rows.

    An anchor has descending limits ``uppers``. Slot ``i`` holds the scores up to limit ``i`` and
    above limit ``i + 1``, so each score lies in one slot. Scores below ``lowest`` are in none. A
    row enters only if it beats the slot's k-th best so far; rows come by ascending id, so that a
    later row with an equal score never does.
    """
    rows = rows.sort_values("vec_id")
    limits = np.full((max(map(len, anchors["uppers"])), len(anchors)), _LEAST)
    for j, uppers in enumerate(anchors["uppers"]):
        limits[: len(uppers), j] = uppers
    lowest = anchors["lowest"].to_numpy()
    names, labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    left = np.array(anchors["vector"].tolist(), dtype=np.int64)
    right = np.array(rows["vector"].tolist(), dtype=np.int64)
    row_names, row_labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    # the score to beat; slot 0 is above all limits and stays shut
    worst = np.full((len(limits) + 1, len(anchors)), _LEAST)
    worst[0] = _MOST
    kept = [np.zeros(0, np.int64)] * 4
    for begin in range(0, len(rows), CHUNK):
        part = slice(begin, begin + CHUNK)
        scores = inner_products(left, right[part])
        slots = np.zeros(scores.shape, np.int8)
        for limit in limits:
            slots += scores <= limit[:, None]
        beaten = worst[slots, np.arange(len(anchors))[:, None]]
        better = (scores > beaten) & (scores >= lowest[:, None])
        better &= (labels[:, None] == row_labels[part]) == same_label
        better &= names[:, None] != row_names[part]
        a, r = np.nonzero(better)
        if not len(a):
            continue
        new = [a, slots[a, r].astype(np.int64), scores[a, r], row_names[part][r]]
        a, slot, score, name = (np.concatenate(x) for x in zip(kept, new, strict=True))
        order = np.lexsort((name, ~score, slot, a))
        a, slot, score, name = a[order], slot[order], score[order], name[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (slot[1:] != slot[:-1])])
        rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
        kept = [x[rank < k] for x in (a, slot, score, name)]
        full = rank == k - 1
        worst[slot[full], a[full]] = score[full]
    a, slot, score, name = kept
    return pd.DataFrame(
        {"anchor_id": names[a], "slot": slot.astype(np.int32), "score": score, "vec_id": name}
    )


def searched(anchors: DataFrame, rows: DataFrame, k: int, same_label: bool, dims: int, size: int):
    """``(anchor_id, slot, score, vec_id)``: the ``k`` best of each slot over all rows.

    Anchors and rows are dealt into blocks by id; each pair of blocks is a task's group, which
    sends on at most ``k`` rows a slot and anchor. Vectors of unlike length are never compared.
    """
    row_blocks = size * dims // ROW_VALUES + 1
    anchor_blocks = anchors.count() * dims // ANCHOR_VALUES + 1

    def dealt(side: DataFrame, own: int, others: int, mine: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        sized = side.toDF(*side.columns).withColumn("dims", F.size("vector"))
        return sized.withColumn(mine, block).withColumn(other, every)

    left = dealt(anchors, anchor_blocks, row_blocks, "a", "r")
    right = dealt(rows, row_blocks, anchor_blocks, "r", "a")
    key = ["dims", "a", "r"]
    schema = "anchor_id long, slot int, score long, vec_id long"

    def cell(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return pd.DataFrame(
                {c: pd.Series(dtype="int64") for c in ("anchor_id", "slot", "score", "vec_id")}
            )
        try:
            return best_of_slots(anchors, rows, k, same_label)
        finally:
            pa.default_memory_pool().release_unused()

    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(cell, schema)
    order = W.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.drop("rank")


def mine(
    rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` are ``(vec_id, label, vector)`` with whole components, one row an id, as
    ``quantised`` gives them; other columns do not matter. Anchors are the rows whose id ``every``
    divides; scores are inner products. An anchor's positives are the best other rows of its
    label. Of the rows of another label, those that have ``low`` to ``high`` percent of a
    positive's score are its window, and the best ``negatives`` of it are returned. Ties go to the
    smaller id. Without positives, or with an empty window, there is no row; of an empty table none.

    The windows of one anchor overlap. Their upper limits cut the scores into disjoint slots; all
    blocks keep the best of each slot, and the best under a limit are those of its slot followed by
    those of the lower slots, merged once from the lowest slot up.
    """
    rows = stored(rows.select("vec_id", "label", "vector"), "negatives-rows")
    size, dims = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    dims = max(1, dims or 1)
    anchors = rows.where(F.col("vec_id") % every == 0)
    free = anchors.withColumn("uppers", F.array(F.lit(int(_MOST)))).withColumn(
        "lowest", F.lit(int(_LEAST))
    )
    best = searched(free, rows, positives, True, dims, size)
    # 100 * n <= high * p, and low * p <= 100 * n, as limits of n
    score = F.col("score")
    wide = score.cast("decimal(20,0)")
    upper, lower = F.floor(wide * high / 100), F.ceil(wide * low / 100)
    found = best.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), score.alias("positive_score"),
        upper.cast("long").alias("upper"), lower.cast("long").alias("lower"),
    ).where("lower <= upper")
    wanted = stored(
        found.groupBy("anchor_id").agg(
            F.sort_array(
                F.collect_list(F.struct("upper", "lower", "positive_score", "positive_id")), False
            ).alias("windows")
        ),
        "negatives-windows",
    )
    limited = anchors.join(wanted.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(
        "vec_id", "label", "vector",
        F.col("windows.upper").alias("uppers"),
        F.array_min("windows.lower").alias("lowest"),
    )
    slots = searched(limited, rows, negatives, False, dims, size)
    lists = slots.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("slot", "score", "vec_id")), False).alias("slots")
    )
    joined = wanted.join(lists, "anchor_id").select("anchor_id", "windows", "slots")
    return joined.mapInArrow(
        tidy(merged(negatives)),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
        "negative_score long",
    )


def merged(k: int):
    """A map that answers every window of an anchor from the best of its slots."""

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                slots: dict[int, list[tuple[int, int]]] = {}
                for entry in row["slots"]:
                    slots.setdefault(entry["slot"], []).append((-entry["score"], entry["vec_id"]))
                suffix: list[tuple[int, int]] = []
                for i in range(len(row["windows"]), 0, -1):
                    suffix = (sorted(slots.get(i, [])) + suffix)[:k]
                    window = row["windows"][i - 1]
                    within = [x for x in suffix if -x[0] >= window["lower"]]
                    for rank, (score, name) in enumerate(within, 1):
                        ids = (row["anchor_id"], window["positive_id"], rank, name)
                        out.append((*ids, window["positive_score"], -score))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                     "negative_score"]
            columns = zip(*out, strict=True) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
            )

    return run
