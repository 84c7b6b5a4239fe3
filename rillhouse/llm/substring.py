"""Removal of repeated passages of words, found by backward search in FM-indexes.

A passage is ``window`` words that follow each other. Every window has a minimizer, the least hash
of the short grams in it; windows side by side with one minimizer form a segment. Equal windows have
equal minimizers, so the segments of a minimizer can be indexed and searched apart from all others.
Equal segments are one class, known by its smallest document; only where different segments share a
minimizer does an index have to tell which windows they share.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rillhouse.llm.common import row_bytes, sized, stored, tidy
from rillhouse.llm.fm_index import FMIndex

WINDOW, GRAM = 50, 8
#: Segments of one minimizer that share an index; more are spread over several, all of which
#: every segment of the minimizer is searched in.
PER_INDEX = 4096
#: About so many segments make up the indexes of one task.
PER_TASK = 4096
KEY = ["minimizer", "content", "length"]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words, repeat(0)), dtype="<u8", count=len(words))


def segments(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """``(start, length, minimizer)`` arrays of the segments of a text, in order."""
    n = len(hashes) - window + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty.astype(np.uint64)
    gram = min(gram, window)
    mixed = np.zeros(len(hashes) - gram + 1, dtype=np.uint64)
    for k in range(gram):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(mixed)]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    span, width = 1, window - gram + 1
    least = mixed
    while 2 * span <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span : width - span + n])
    begins = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(begins[1:], n)
    return begins, ends - begins + window - 1, least[begins]


def segment_table(docs: DataFrame, window: int) -> DataFrame:
    """``(doc_id, text_hash, start, length, minimizer, content)`` of all documents with an id."""

    def run(batches):
        for batch in batches:
            parts = []
            names = batch.column("doc_id").to_numpy()
            marks = batch.column("text_hash").to_numpy()
            for name, mark, text in zip(names, marks, batch.column("text"), strict=True):
                hashes = word_hashes((text.as_py() or "").encode().split())
                start, length, minimizer = segments(hashes, window)
                if not len(start):
                    continue
                raw = memoryview(hashes.tobytes())
                content = np.fromiter(
                    (
                        xxh64_intdigest(raw[8 * a : 8 * (a + b)])
                        for a, b in zip(start.tolist(), length.tolist(), strict=True)
                    ),
                    dtype="<u8",
                )
                parts.append((
                    np.full(len(start), name), np.full(len(start), mark), start, length,
                    minimizer.view(np.int64), content.view(np.int64),
                ))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                columns[2:4] = [c.astype(np.int32) for c in columns[2:4]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns],
                    ["doc_id", "text_hash", "start", "length", "minimizer", "content"],
                )

    return docs.mapInArrow(
        tidy(run),
        "doc_id long, text_hash long, start int, length int, minimizer long, content long",
    )


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``spans(doc_id, text_hash, spans array)``, both dealt by document."""
    return docs.join(spans, ["doc_id", "text_hash"], how)


def shared_windows(
    table: DataFrame, classes: DataFrame, docs: DataFrame, window: int
) -> DataFrame:
    """``(*KEY, begin, end)``: words of a class that windows of smaller documents cover.

    Only classes whose minimizer has other classes enter. Of each its first document lends the
    words; indexes of at most ``PER_INDEX`` segments are built per task.
    """
    rivals = classes.groupBy("minimizer").agg(
        F.count("*").alias("n"), F.min("first").alias("lowest")
    )
    rivals = rivals.where("n > 1").withColumn("parts", F.ceil(F.col("n") / PER_INDEX).cast("int"))
    chosen = stored(
        classes.join(rivals, "minimizer").select(*KEY, "first", "lowest", "parts"), "sub-rivals"
    )
    placed = stored(
        table.join(sized(chosen), KEY)
        .where("doc_id = first")
        .groupBy(*KEY, "first", "lowest", "parts")
        .agg(F.min(F.struct("text_hash", "start")).alias("at"))
        .select(*KEY, "first", "lowest", "parts", "at.*"),
        "sub-places",
    )
    spans = placed.groupBy(F.col("first").alias("doc_id"), "text_hash").agg(
        F.collect_list(F.struct("start", *KEY, "lowest", "parts")).alias("spans")
    )
    spans = sized(spans, placed.count() * row_bytes(placed))

    def cut(batches):
        for batch in batches:
            rows = []
            for name, text, found in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("text"),
                batch.column("spans").to_pylist(),
                strict=True,
            ):
                hashes = word_hashes(text.as_py().encode().split())
                for s in found:
                    words = hashes[s["start"] : s["start"] + s["length"]].tobytes()
                    rows.append((*(s[k] for k in KEY), name, s["lowest"], s["parts"], words))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    long, int_ = pa.int64(), pa.int32()
    kinds = [long, long, int_, long, long, int_, pa.binary()]
    names = [*KEY, "first", "lowest", "parts", "words"]
    schema = (
        "minimizer long, content long, length int, first long, lowest long, parts int, words binary"
    )
    whole = keyed(docs).where("doc_id is not null and text is not null")
    passages = with_spans(whole, spans, "inner").select("doc_id", "text", "spans")
    cut_out = stored(passages.mapInArrow(tidy(cut), schema), "sub-passages")
    tasks = cut_out.count() // PER_TASK + 1
    # a segment is held by one index of its minimizer and asks all of them
    own, asks = F.pmod("content", F.col("parts")).cast("int"), F.col("first") > F.col("lowest")
    roles = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda p: F.struct(p.alias("part"), (p == own).alias("held"), asks.alias("asks")),
        ),
        lambda role: role["held"] | role["asks"],
    )
    dealt = cut_out.select(*KEY, "first", "words", F.explode(roles).alias("role")).select(
        *KEY,
        "first",
        "words",
        "role.held",
        "role.asks",
        F.pmod(F.xxhash64("minimizer", "role.part"), F.lit(tasks)).alias("shard"),
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        held = group[group["held"]].drop_duplicates(KEY)
        asks = group[group["asks"]].drop_duplicates(KEY)
        rows = []
        if len(held) and len(asks):
            passages = [np.frombuffer(w, "<u8") for w in held["words"]]
            index = FMIndex(passages, held["first"].to_numpy(), window)
            sizes = asks["length"].to_numpy(dtype=np.int64)
            words = np.frombuffer(b"".join(asks["words"]), "<u8")
            offset = np.cumsum(sizes) - sizes
            counts = sizes - window + 1
            row = np.repeat(np.arange(len(asks)), counts)
            local = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            own = asks["first"].to_numpy(dtype=np.int64)[row]
            found = index.smallest_owner(words, offset[row] + local, own) < own
            row, local = row[found], local[found]
            if len(row):
                new = np.flatnonzero(
                    np.concatenate([[True], (row[1:] != row[:-1]) | (local[1:] != local[:-1] + 1)])
                )
                last = np.append(new[1:], len(row)) - 1
                rows = [
                    asks[KEY].to_numpy()[row[new]],
                    np.stack([local[new], local[last] + window], axis=1),
                ]
        data = np.concatenate(rows, axis=1) if rows else np.empty((0, 5), np.int64)
        return pd.DataFrame(data.astype(np.int64), columns=[*KEY, "begin", "end"])

    out = "minimizer long, content long, length int, begin int, end int"
    return dealt.groupBy("shard").applyInPandas(search, out)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, text_hash, spans)``: per document the words to remove, as ``[begin, end)``.

    A word goes if a window over it has a word sequence that also starts in a document with a
    smaller id. Rows with one id do not remove from each other; rows without an id neither remove
    nor are removed from. Texts shorter than a window have no window.
    """
    named = keyed(docs).where("doc_id is not null and text is not null")
    table = stored(segment_table(named, window), "sub-segments")
    classes = stored(
        table.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.count("*").alias("n")),
        "sub-classes",
    )
    later = table.join(classes.where("n > 1").select(*KEY, "first"), KEY).where("doc_id > first")
    whole = later.select(
        "doc_id", "text_hash", "start", (F.col("start") + F.col("length")).alias("stop")
    )
    found = stored(shared_windows(table, classes.drop("n"), docs, window), "sub-found")
    part = (
        table.join(sized(found).join(classes.drop("n"), KEY), KEY)
        .where("doc_id = first")
        .select(
            "doc_id",
            "text_hash",
            (F.col("start") + F.col("begin")).alias("start"),
            (F.col("start") + F.col("end")).alias("stop"),
        )
    )
    return (
        whole.union(part)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with ``kept`` (its words that stay, by single spaces), ``n_words``,
    ``n_removed`` and ``kept_sha256``.

    Null and blank texts keep nothing and lose nothing. Columns of the input with these names are
    replaced.
    """
    made = ["text_hash", "spans", "kept", "n_words", "n_removed", "kept_sha256"]
    plain = docs.drop(*made)
    spans = stored(repeated_spans(plain, window), "sub-spans")
    # a span is held in 40 bytes, and stored in few
    n_spans = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    spans = sized(spans, spans.count() * row_bytes(spans) + 40 * n_spans)
    marked = plain.withColumn("text_hash", F.xxhash64("text"))
    columns = plain.columns
    joined = with_spans(marked, spans, "left").select(*columns, "spans")

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(
                batch.column("text"), batch.column("spans").to_pylist(), strict=True
            ):
                words = (text.as_py() or "").encode().split()
                n = len(words)
                if spans:
                    edges = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(edges, [s["start"] for s in spans], 1)
                    np.add.at(edges, [s["stop"] for s in spans], -1)
                    stay = np.cumsum(edges[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                kept = b" ".join(words)
                rows.append((kept.decode(), n, n - len(words), hashlib.sha256(kept).hexdigest()))
            results = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(results, kinds, strict=True))],
                [*columns, "kept", "n_words", "n_removed", "kept_sha256"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return joined.mapInArrow(
        tidy(run), f"{schema}, kept string, n_words long, n_removed long, kept_sha256 string"
    )
