"""SimHash near-duplicates through an inverted index of bytes by position."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rillhouse.llm.common import components, shuffled, sized, stored, tidy, unused


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits as a signed number; a bit is set if it is in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *keep: str) -> DataFrame:
    """``(doc_id, fp)`` of whole texts, and further long columns; null and blank texts have
    fingerprint zero."""

    def run(batches):
        for batch in batches:
            marks = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(marks, pa.int64()), *map(batch.column, keep)],
                ["doc_id", "fp", *keep],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
    schema = ", ".join(["doc_id long", "fp long", *[f"`{c}` long" for c in keep]])
    return rows.mapInArrow(tidy(run), schema)


def close_pairs(marks: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``(a, b)`` with ``a < b`` of distinct ``marks(fp)`` that differ in few bits.

    ``max_bits`` bits touch as many bytes at most, so a close pair shares at least
    ``8 - max_bits`` bytes in their positions. The index has a posting for each choice of that many
    positions; pairs that meet are tallied byte by byte, kept from the guaranteed number of shared
    bytes on, and verified bit by bit. Postings by single bytes would hold 1/256 of all rows each;
    these leave ``8 * max_bits`` bits free, so a posting is never larger than 2^16 fingerprints at
    two bits, however many copies the corpus holds. They are many times the fingerprints that Spark
    sees in the files, so they must not be broadcast by that size.
    """
    least = 8 - max_bits
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(8), least)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    postings = marks.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
    )
    left, right = postings.toDF("a", "pos", "col"), postings.toDF("b", "pos", "col")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum(
        (F.shiftrightunsigned(differ, 8 * p).bitwiseAND(F.lit(0xFF)) == 0).cast("int")
        for p in range(8)
    )
    met = left.join(
        shuffled(right),
        (left.pos == right.pos)
        & (left.col == right.col)
        & (F.col("a") < F.col("b"))
        & (tally >= least)
        & (F.bit_count(differ) <= max_bits),
    )
    return met.select("a", "b").distinct()


def groups(marked: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root, component_id)`` of stored ``marked(doc_id, fp)``: its group's own fingerprint and
    smallest id. Equal fingerprints are one class, so thousands of copies never meet in pairs."""
    classes = stored(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes"
    )
    linked = components(close_pairs(classes.select("fp"), max_bits), "simhash-links")
    rooted = sized(linked).join(classes, linked.node == classes.fp).select("fp", "root", "first")
    named = rooted.join(
        rooted.groupBy("root").agg(F.min("first").alias("smallest")), "root"
    ).select("fp", "root", "smallest")
    return classes.join(named, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.coalesce("smallest", "first").alias("component_id"),
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``, repeats and nulls included.

    The component is named by its smallest id; a group whose ids are all null has a null name.
    Null, empty and blank texts share fingerprint zero and link like any other.
    """
    marked = stored(fingerprints(docs, shingle), "simhash-marks")
    named = groups(marked, max_bits)
    return sized(marked).join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each group: the one with the smallest id.

    Rows that share an id are documents of their own, each in the group of its text. Of several
    rows with a group's smallest id the one with the smallest fingerprint stays, then by a hash of
    its text, then of its other columns; ids that are null come last.
    """
    text, order = unused("text_hash", docs), unused("row_order", docs)
    hashed = F.xxhash64("text")
    marked = stored(fingerprints(docs.withColumn(text, hashed), shingle, text), "simhash-marks")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", text)).alias("first")
    rooted = sized(marked).join(groups(marked.select("doc_id", "fp"), max_bits), "fp")
    kept = rooted.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col(f"first.{text}").alias("kept_text")
    )
    kept = stored(kept, "simhash-kept")
    rows = docs.withColumn(text, hashed)
    same = rows["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (
        rows[text] == kept["kept_text"]
    )
    stay = rows.join(sized(kept), same, "left_semi")
    repeats = W.partitionBy("doc_id", text).orderBy(F.xxhash64(*docs.columns))
    one = stay.withColumn(order, F.row_number().over(repeats)).where(F.col(order) == 1)
    return one.select(*docs.columns)
