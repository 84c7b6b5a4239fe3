"""Packing by deficit round-robin over the sources' queues, so that every window keeps the mix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import stored, tidy
from rillhouse.llm.tokens import encoder

#: A source is served in turns of whole packets: a document's ids, cut after so many.
PACKET = 512
#: Quanta are whole numbers of 2^-16 tokens.
UNIT = 1 << 16
#: About so many documents of one source are put in order by one task.
PER_TASK = 20_000
#: The positions of at most so many groups of rounds are added up on the driver.
GROUPS = 1 << 16


def id_type(tokenizer: str, end_id: int) -> str:
    """How ids are kept on the way: in 16 bits if all of the vocabulary fit."""
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """``(key, doc_id, source, tokens, ids)``: a document's ids and ``end_id``, of ``id_type``.

    ``key`` differs for all rows. A null or empty text is its end alone; ids and sources may be
    null or repeat.
    """
    kind = id_type(tokenizer, end_id)

    def run(batches):
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 40
        encode = encoder(tokenizer, True).encode
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            names, sources = batch.column("doc_id"), batch.column("source")
            begin, size, ids = 0, 0, []
            for text in batch.column("text"):
                ids.append(encode(text.as_py()).astype(kind).tobytes() + end)
                size += len(ids[-1])
                if size > 16 << 20 or begin + len(ids) == len(names):
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.arange(key, key + n)),
                            names.slice(begin, n),
                            sources.slice(begin, n),
                            pa.array([len(x) // len(end) for x in ids], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        ["key", "doc_id", "source", "tokens", "ids"],
                    )
                    begin, size, ids, key = begin + n, 0, [], key + n

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(
        tidy(run), "key long, doc_id long, source string, tokens long, ids binary"
    )


def quanta(totals: DataFrame, window: int, weights: DataFrame | None = None) -> DataFrame:
    """``(source, quantum)``: what a source is given each round, in ``UNIT``s; a round is a window.

    Without ``weights(source, weight)`` a source's share is its share of all tokens, and all queues
    run dry together. With them, sources that have no positive weight share what a queue of the
    average weight gets; when a queue runs dry the others keep their proportions.
    """
    if weights is None:
        shares = totals.withColumn("share", F.col("total").cast("double"))
    else:
        known = weights.where("weight > 0").select(
            F.col("source").alias("named"), F.col("weight").cast("double").alias("share")
        )
        shares = totals.join(known, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
        mean, rest = shares.agg(
            F.avg("share"), F.count(F.when(F.col("share").isNull(), 1))
        ).first()
        shares = shares.fillna((mean or 1.0) / max(1, rest), ["share"])
    whole = shares.agg(F.sum("share")).first()[0] or 1.0
    quantum = F.greatest(F.round(F.col("share") * (window * UNIT / whole)), F.lit(1.0))
    return shares.select("source", quantum.cast("long").alias("quantum"))


def queued(slim: DataFrame) -> DataFrame:
    """``slim`` with ``begin``: the tokens of its source's documents before it.

    The order of a queue is by a hash of ``doc_id``, the same in every run; ``doc_id``, the number of
    tokens and the crc of the ids break ties, so that only equal documents may change places.
    A queue is cut into hash ranges, whose sums are added up per source: a source with a third of
    all documents is in order without any task that holds it.
    """
    salts = slim.count() // PER_TASK + 1
    hashed = F.xxhash64(F.col("doc_id"))
    salted = slim.withColumn("salt", F.pmod(hashed, F.lit(salts)))
    sums = salted.groupBy("source", "salt").agg(F.sum("tokens").alias("sum"))
    before = W.partitionBy("source").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    shifts = stored(
        sums.select("source", "salt", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("shift")),
        "mixture-shifts",
    ).toDF("shift_source", "shift_salt", "shift")
    order = W.partitionBy("source", "salt").orderBy(hashed, "doc_id", "tokens", "crc", "key")
    inside = F.coalesce(
        F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    same = F.col("source").eqNullSafe(F.col("shift_source")) & (
        F.col("salt") == F.col("shift_salt")
    )
    placed = salted.withColumn("inside", inside).join(shifts, same)
    return placed.withColumn("begin", F.col("inside") + F.col("shift")).select(
        *slim.columns, "begin"
    )


def packets(queue: DataFrame, packet: int) -> DataFrame:
    """``(key, source, round, at, start, length)``: in which round each packet is served.

    After ``r`` rounds a source was given ``r`` quanta and has served all packets that end within
    them; the rest is its deficit, carried on. So a packet is served in the first round whose
    quanta reach its end, which every task can tell for its own documents.
    """
    number = F.col("start") + F.least(F.lit(packet), F.col("tokens") - F.col("start"))
    ends = F.col("begin") + number
    served = F.expr(f"(ends * {UNIT}L + quantum - 1) div quantum")
    return (
        queue.withColumn(
            "start", F.explode(F.expr(f"sequence(0L, tokens - 1, {packet}L)"))
        )
        .withColumn("ends", ends)
        .select(
            "key", "source", served.alias("round"), (F.col("begin") + F.col("start")).alias("at"),
            "start", (F.col("ends") - F.col("begin") - F.col("start")).alias("length"),
        )
    )


def positions(served: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Stored packets with ``position``: the tokens of all packets before it, by round, source and
    place in the queue.

    Rounds are taken together in at most ``groups`` groups, whose sums are added up first; a group
    has all sources' packets of its rounds, so none is hot.
    """
    last = served.agg(F.max("round")).first()[0] or 0
    width = max(64, last // groups + 1)
    grouped = served.withColumn("group", F.expr(f"round div {width}"))
    sums = sorted(grouped.groupBy("group").agg(F.sum("length")).collect())
    begins = np.cumsum([0, *[n for _, n in sums]])[:-1].tolist()
    spark = served.sparkSession
    shifts = spark.createDataFrame(
        [(g, b) for (g, _), b in zip(sums, begins, strict=True)], "group long, shift long"
    )
    order = W.partitionBy("group").orderBy(
        "round", F.col("source").asc_nulls_last(), "at"
    )
    inside = F.coalesce(
        F.sum("length").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    joined = grouped.withColumn("inside", inside).join(F.broadcast(shifts), "group")
    return joined.select(
        "key", "start", "length", (F.col("inside") + F.col("shift")).alias("position")
    )


def tail_edges(total: int, capacity: int) -> list[int]:
    """Where sequences after the last full one end: what is left, cut into powers of two."""
    at, edges = total - total % capacity, []
    for bit in reversed(range(capacity.bit_length())):
        if (total - at) >> bit & 1 and 1 << bit < capacity:
            edges.append(at + (1 << bit))
            at = edges[-1]
    if at < total:  # a capacity that is no power of two leaves at most a padded sequence
        edges.append(total)
    return edges


def place(
    cut: DataFrame, capacity: int = 2048, packet: int = PACKET, weights: DataFrame | None = None,
    kind: str = "<u4",
) -> DataFrame:
    """Stored ``encoded`` rows as pieces: ``(doc_id, source, start, length, ids, doc_tokens,
    sequence_id, offset)``; ``kind`` is the type of the stored ids, the pieces have 32-bit ids."""
    slim = cut.select("key", "doc_id", "source", "tokens", F.crc32("ids").alias("crc"))
    totals = stored(
        slim.groupBy("source").agg(F.sum("tokens").alias("total")), "mixture-totals"
    )
    given = stored(quanta(totals, capacity, weights), "mixture-quanta").toDF("given", "quantum")
    queue = queued(slim).join(given, F.col("source").eqNullSafe(F.col("given")))
    served = stored(packets(queue, packet), "mixture-packets")
    total = totals.agg(F.sum("total")).first()[0] or 0
    begins = Sequences(total, capacity)
    lists = positions(served).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "position"))).alias("packets")
    )

    def run(batches):
        for batch in batches:
            row, start, number, offset, length = pieces_of(batch.column("packets"), begins)
            ids = [
                np.frombuffer(x.as_buffer(), kind).astype("<u4").tobytes()
                for x in batch.column("ids")
            ]
            spans = zip(row.tolist(), (4 * start).tolist(), (4 * (start + length)).tolist(),
                        strict=True)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("source").take(rows),
                    pa.array(start),
                    pa.array(length),
                    pa.array([ids[r][a:b] for r, a, b in spans], pa.binary()),
                    batch.column("tokens").take(rows),
                    pa.array(number),
                    pa.array(offset),
                ],
                ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    whole = cut.join(lists, "key").select("doc_id", "source", "tokens", "ids", "packets")
    return whole.mapInArrow(
        tidy(run),
        "doc_id long, source string, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long",
    )


class Sequences:
    """Where the sequences of a stream begin: full ones first, then those of the tail."""

    def __init__(self, total: int, capacity: int) -> None:
        self.capacity, self.full = capacity, total // capacity
        self.tail = np.array([self.full * capacity, *tail_edges(total, capacity)], np.int64)

    def begin(self, number: np.ndarray) -> np.ndarray:
        last = np.clip(number - self.full, 0, len(self.tail) - 1)
        return np.where(number < self.full, number * self.capacity, self.tail[last])

    def number(self, position: np.ndarray) -> np.ndarray:
        behind = self.full + np.searchsorted(self.tail, position, side="right") - 1
        return np.where(position < self.tail[0], position // self.capacity, behind)


def pieces_of(packets: pa.ListArray, sequences: Sequences) -> tuple[np.ndarray, ...]:
    """``(row, start, sequence, offset, length)`` of the pieces of some documents' packets.

    Packets that follow each other in the document and in the stream are one piece, which ends
    where a sequence does.
    """
    flat = packets.flatten()
    start, length, position = (flat.field(k).to_numpy() for k in range(3))
    row = np.repeat(np.arange(len(packets)), packets.value_lengths().to_numpy())
    follows = (row[1:] == row[:-1]) & (start[1:] == start[:-1] + length[:-1])
    follows &= position[1:] == position[:-1] + length[:-1]
    first = np.flatnonzero(np.r_[True, ~follows][: len(row)])
    row, start, position = row[first], start[first], position[first]
    end = position + (np.add.reduceat(length, first) if len(first) else length)
    low, high = sequences.number(position), sequences.number(end - 1)
    which = np.repeat(np.arange(len(row)), high - low + 1)
    number = np.arange(len(which)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1) - low,
                                               high - low + 1)
    begin = sequences.begin(number)
    a = np.maximum(position[which], begin)
    b = np.minimum(end[which], sequences.begin(number + 1))
    return row[which], start[which] + a - position[which], number, a - begin, b - a


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048,
    packet: int = PACKET, weights: DataFrame | None = None,
) -> DataFrame:
    """The pieces of all documents with their ids and their place in sequences of ``capacity``.

    Documents need ``doc_id``, ``source`` and ``text``; other columns do not matter. Every source,
    null among them, has a queue. A round gives each queue its share of one window; it serves
    packets of at most ``packet`` tokens while the given tokens last and carries its deficit on,
    over windows and over the partitions that hold the queue. After any number of windows a source
    is less than one packet and one token behind its share. The packets of all rounds make one
    stream; sequences are its cuts, so only the last could need padding, and what is left there
    is cut into sequences whose lengths are powers of two, at most ``log2(capacity)`` of them.

    ``weights(source, weight)`` sets other shares than those of the tokens that the sources have.
    Repeated documents are packed as often as they come; of an empty table there is no piece.
    """
    cut = stored(encoded(docs, tokenizer, end_id), "mixture-ids")
    return place(cut, capacity, packet, weights, id_type(tokenizer, end_id))
