"""Near-duplicate vectors through product quantisation.

Vectors lie in coarse inverted lists; of each, the difference to its list's centre is kept as a few
one-byte codes of subspaces, and the length of the error that the codes leave. A query is compared
with the codes by sums of table entries over half of the subspaces; the other half is added where
that sum is not too much already. What may be near enough, given the error, is compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import components, stored
from rillhouse.llm.vectors import cluster, matrix, sampled, squared, units, usable

SUBSPACES, CODES = 16, 256
#: Index rows that one group holds at most, about, and queries that it compares with them at once.
PER_GROUP = 2048
#: A group holds so many times these queries.
TURNS = 4
#: Queries whose tables are made together: with 256 code words, they stay in a core's cache.
TABLES = 256
#: Numbers that pairs compared at once have on either side, at most.
NUMBERS = 1 << 22
#: More lists than these are not made, as every vector is compared with all centres.
MOST_LISTS = 4096
#: What rounding to 32 bits may change of a sum, which is 16 at most, with each term that it adds.
ROUNDING = 16 * 2.0**-24


@dataclass
class Quantizer:
    """Coarse centres and, by subspace, the code words of what remains."""

    centres: np.ndarray
    edges: np.ndarray
    words: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int) -> Quantizer:
        centres = cluster(sample, lists)
        rest = sample - centres[squared(sample, centres).argmin(axis=1)]
        dims = sample.shape[1]
        edges = np.linspace(0, dims, min(SUBSPACES, dims) + 1).astype(int)
        spans = zip(edges, edges[1:], strict=False)
        return cls(centres, edges, [cluster(rest[:, a:b], CODES, rounds=6) for a, b in spans])

    def encode(self, vectors: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and lengths of the errors."""
        rest = vectors - self.centres[lists]
        codes = np.empty((len(vectors), len(self.words)), dtype=np.uint8)
        error = np.zeros(len(vectors))
        for m, (a, b) in enumerate(zip(self.edges, self.edges[1:], strict=False)):
            codes[:, m] = squared(rest[:, a:b], self.words[m]).argmin(axis=1)
            gone = rest[:, a:b] - self.words[m][codes[:, m]]
            error += (gone * gone).sum(axis=1)
        return codes, np.sqrt(error)

    def summed(self, rest: np.ndarray, codes: np.ndarray, some: int) -> np.ndarray:
        """Squared distances of coded vectors (down) to what remains of queries (across).

        Over the first ``some`` subspaces, by lookup in tables of a row for each code word. A table
        is one product: the words, their squares and 1 times -2 rests, 1 and the rests' squares.
        """
        total = np.zeros((len(codes), len(rest)), rest.dtype)
        entries = np.empty_like(total)
        for m, (a, b) in enumerate(zip(self.edges[:some], self.edges[1:], strict=False)):
            w, r = self.words[m].astype(rest.dtype), rest[:, a:b]
            left = np.column_stack([w, (w * w).sum(axis=1), np.ones_like(w[:, 0])])
            right = np.column_stack([-2 * r, np.ones_like(r[:, 0]), (r * r).sum(axis=1)])
            pick = codes[:, m].astype(np.intp)
            total += np.take(left @ right.T, pick, axis=0, out=entries, mode="clip")
        return total

    def distances(self, queries: np.ndarray, one: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to coded vectors of list ``one``, by table lookup."""
        found = self.summed(queries - self.centres[one], codes, len(self.words))
        return np.maximum(found.T, 0)

    def within(
        self, queries: np.ndarray, one: int, codes: np.ndarray, most: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a coded vector of list ``one`` at most ``most[vector]`` apart.

        Some pairs may be farther by what rounding adds, none that is near enough is left out. Half
        of the subspaces are summed for all pairs, the others for those that may still be near.
        """
        terms = queries.shape[1] + 3 * SUBSPACES
        limit = (most * most + terms * ROUNDING).astype(np.float32)
        half = (len(self.words) + 1) // 2
        cut = self.edges[half]
        words = [w[codes[:, m]] for m, w in enumerate(self.words)][half:]
        words = np.concatenate([np.empty((len(codes), 0)), *words], axis=1).astype(np.float32)
        step = NUMBERS // queries.shape[1] + 1
        found = [(np.empty(0, np.intp), np.empty(0, np.intp))]
        for start in range(0, len(queries), TABLES):
            rest = (queries[start : start + TABLES] - self.centres[one]).astype(np.float32)
            total = self.summed(rest, codes, half)
            left = np.flatnonzero(total <= limit[:, None])
            for a in range(0, len(left), step):
                j, i = np.divmod(left[a : a + step], len(rest))
                gone = rest[i, cut:] - words[j]
                near = total[j, i] + (gone * gone).sum(axis=1) <= limit[j]
                found.append((i[near] + start, j[near]))
        i, j = zip(*found, strict=True)
        return np.concatenate(i), np.concatenate(j)

    def probes(self, vectors: np.ndarray, reach: float) -> list[np.ndarray]:
        """Per vector its own list, and those whose border is within ``reach`` of it.

        The border between two lists is the plane halfway between their centres; what lies within
        ``reach`` of a vector, on the other side, can't be farther from it than that.
        """
        d = squared(vectors, self.centres)
        own = d.argmin(axis=1)
        between = np.sqrt(squared(self.centres, self.centres))
        near = d - d[np.arange(len(d)), own][:, None] <= 2 * reach * between[own] + 1e-12
        near[np.arange(len(d)), own] = True
        return [np.flatnonzero(row) for row in near]


def local_roots(i: np.ndarray, j: np.ndarray, q: int, x: int) -> tuple[np.ndarray, np.ndarray]:
    """Least label in each component of a two-sided graph, of its ``q`` rows and ``x`` columns.

    Links join row ``i`` with column ``j``. Rows have labels from 0, columns from ``q`` on.
    """
    rows, cols = np.arange(q), np.arange(q, q + x)
    while True:
        new_rows, new_cols = rows.copy(), cols.copy()
        np.minimum.at(new_cols, j, rows[i])
        np.minimum.at(new_rows, i, new_cols[j])
        if (new_rows == rows).all() and (new_cols == cols).all():
            return rows, cols
        rows, cols = new_rows, new_cols


def near_duplicates(vectors: DataFrame, least: float = 0.95, spread: float = 4.0) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for each row of ``vectors``.

    Vectors link from a cosine of ``least`` on. Equal vectors are one class; classes are compared,
    and links counted by the size of classes. Within a group every pair is compared by codes: as a
    code distance differs from the true one by the error's length at most, none is lost there.
    Lists hold about half of ``PER_GROUP`` vectors, however many there are in all: what is compared
    and what is sent grow alike, each slower than with the square of the vectors. A vector probes its own list and every list whose border is within ``spread`` standard
    deviations of where a partner at the largest distance lies in a random direction; a pair is
    found if either probes the other's list. Groups send counts and one link per vector at most,
    however many pairs they hold.

    Vectors that cannot be compared, and rows without an id, link with nothing; the component of a
    row without an id is null and it is not kept. Rows with one id count as one vector if equal;
    of different vectors with one id the counts are those of the id.
    """
    rows = stored(usable(vectors).distinct(), "pq-rows")
    spark = rows.sparkSession
    classes = rows.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    # of different vectors with one id, each stays a class: a number of its own tells them apart
    classes = stored(classes.select(F.xxhash64("vector").alias("tie"), "*"), "pq-classes")
    count = classes.count()
    if count == 0:
        none = "vec_id long, n_links long, component_id long"
        return _result(vectors, spark.createDataFrame([], none))
    sample = sampled(classes)
    book = Quantizer.fit(sample, min(MOST_LISTS, 1 + 2 * count // PER_GROUP))
    dims = sample.shape[1]
    far = float(np.sqrt(2 * (1 - least)))
    reach = min(far, spread * far / np.sqrt(dims))

    def encode(frames):
        for frame in frames:
            if len(frame):
                given = matrix(frame["vector"])
                v = units(given)
                lists = squared(v, book.centres).argmin(axis=1)
                codes, error = book.encode(v, lists)
                yield frame.assign(
                    vector=[row.tobytes() for row in given],
                    list=lists.astype(np.int32),
                    codes=[c.tobytes() for c in codes],
                    error=error,
                    probed=[p.astype(np.int32) for p in book.probes(v, reach)],
                )

    coded = stored(
        classes.mapInPandas(
            encode,
            "tie long, vector binary, first long, n long, list int, codes binary, error double, "
            "probed array<int>",
        ),
        "pq-index",
    )
    sizes = np.zeros(len(book.centres), dtype=np.int64)
    for r in coded.groupBy("list").count().collect():
        sizes[r[0]] = r[1]
    asks = np.zeros(len(book.centres), dtype=np.int64)
    asked = coded.select(F.explode("probed").alias("list"))
    for r in asked.groupBy("list").count().collect():
        asks[r[0]] = r[1]
    parts = F.array(*[F.lit(int(p)) for p in sizes // PER_GROUP + 1])
    turns = F.array(*[F.lit(int(p)) for p in asks // (TURNS * PER_GROUP) + 1])
    item = F.hash("first", "tie")
    columns = ["first", "tie", "n", "vector", "list"]
    held = coded.select(
        F.col("list").alias("at"),
        F.pmod(item, F.element_at(parts, F.col("list") + 1)).alias("part"),
        F.explode(F.sequence(F.lit(0), F.element_at(turns, F.col("list") + 1) - 1)).alias("turn"),
        *columns, "codes", "error", "probed",
    )
    queries = coded.select(*columns, F.explode("probed").alias("at")).select(
        "at",
        F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("at") + 1) - 1)).alias("part"),
        F.pmod(item, F.element_at(turns, F.col("at") + 1)).alias("turn"),
        *columns,
    )
    names = ["first", "tie", "links", "root_first", "root_tie"]

    def vectors_of(frame: pd.DataFrame) -> np.ndarray:
        return units(np.frombuffer(b"".join(frame["vector"]), np.float64).reshape(len(frame), -1))

    def compare(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        at, lists = int(key[0]), len(book.centres)
        none = pd.DataFrame({c: np.empty(0, np.int64) for c in names})
        if not len(index) or not len(queries):
            return none
        index = index.sort_values(["first", "tie"], ignore_index=True)
        queries = queries.sort_values(["first", "tie"], ignore_index=True)
        x = vectors_of(index)
        codes = np.frombuffer(b"".join(index["codes"]), np.uint8).reshape(len(x), -1)
        most = far + 1e-9 + index["error"].to_numpy()
        ids_x, n_x = index[["first", "tie"]].to_numpy(), index["n"].to_numpy()
        probing = np.repeat(np.arange(len(x)), [len(p) for p in index["probed"]]) * lists
        probing += np.concatenate(index["probed"].to_list())

        def block(queries: pd.DataFrame) -> pd.DataFrame:
            q = vectors_of(queries)
            ids_q, n_q = queries[["first", "tie"]].to_numpy(), queries["n"].to_numpy()
            i, j = book.within(q, at, codes, most)
            near = (ids_q[i] != ids_x[j]).any(axis=1)
            step = NUMBERS // x.shape[1] + 1
            for a in range(0, len(i), step):
                s = slice(a, a + step)
                near[s] &= (q[i[s]] * x[j[s]]).sum(axis=1) >= least
            i, j = i[near], j[near]
            # the other side counts the pair itself if it probes this query's list
            own = queries["list"].to_numpy()[i]
            alone = (own != at) & ~np.isin(j * lists + own, probing)
            links = np.zeros(len(q) + len(x), dtype=np.int64)
            np.add.at(links, i, n_x[j])
            np.add.at(links, len(q) + j[alone], n_q[i[alone]])
            ids = np.concatenate([ids_q, ids_x])
            roots = np.concatenate(local_roots(i, j, len(q), len(x)))
            out = np.column_stack([ids, links, ids[roots]])
            linked = (links > 0) | (out[:, :2] != out[:, 3:]).any(axis=1)
            return pd.DataFrame(out[linked].astype(np.int64), columns=names)

        cuts = range(0, len(queries), PER_GROUP)
        return pd.concat([none, *[block(queries[a : a + PER_GROUP]) for a in cuts]])

    found = stored(
        held.groupBy("at", "part", "turn")
        .cogroup(queries.groupBy("at", "part", "turn"))
        .applyInPandas(compare, "first long, tie long, links long, root_first long, root_tie long"),
        "pq-found",
    )
    counts = found.groupBy("first", "tie").agg(F.sum("links").alias("links"))
    # a node of the graph is an id; classes of one id are one node
    edges = found.select(F.col("first").alias("a"), F.col("root_first").alias("b"))
    shared = rows.select("vec_id", F.xxhash64("vector").alias("tie"), "vector")
    member = shared.join(classes.select("vector", "first", "n"), "vector").select(
        "vec_id", "tie", "first", "n"
    )
    member = stored(member, "pq-members")
    edges = edges.union(member.select(F.col("vec_id").alias("a"), F.col("first").alias("b")))
    roots = components(edges, "pq-links")
    named = roots.toDF("vec_id", "component_id")
    per_id = (
        member.join(counts, ["first", "tie"], "left")
        .groupBy("vec_id")
        .agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    return _result(vectors, per_id.join(named, "vec_id", "left"))


def _result(vectors: DataFrame, linked: DataFrame) -> DataFrame:
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    component = F.coalesce("component_id", "vec_id")
    return every.join(linked, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
