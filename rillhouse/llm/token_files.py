"""Token ids in compressed files that give access to single short documents.

A file holds documents in ascending order of their ids:

    magic     8 bytes  ``TIDZ1`` and three zero bytes
    frames             one zstandard frame per document, of its 32-bit ids
    index              per document 8 bytes each: doc_id, end of its frame, token ids up to its end
    nulls              one byte per document: 1 where doc_id is null
    foot     32 bytes  dictionary hash (first bytes of its SHA-256), documents, token ids, magic

Numbers are little-endian. The dictionary, trained on serialized id arrays, lies beside the files
and is shared by all of them; a reader refuses a file whose hash is not that of its dictionary.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import stored
from rillhouse.llm.tokens import encoder
from rillhouse.session import scratch

MAGIC = b"TIDZ1\0\0\0"
FOOT = "<8sqq8s"
FOOT_BYTES = struct.calcsize(FOOT)
#: The dictionary learns from so many documents at most, of each from so many ids at its start;
#: it decides about size alone, never about content.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 2000, 4096, 64 << 10
#: Characters of text per file, about.
FILE_CHARS = 16 << 20
#: Files whose sizes one task sums up.
BLOCK = 1024


def shared_uri(path: str) -> str:
    """A path of Spark as Arrow's file systems take it."""
    if "://" in path:
        return path
    return "file://" + path.removeprefix("file:")


def digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:8]


def token_bytes(encode, text: str | None, end_id: int) -> bytes:
    return np.append(encode(text), np.uint32(end_id)).astype("<u4").tobytes()


def train(docs: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A dictionary from the documents with the smallest hashes; empty if they are too few."""
    sample = (
        docs.select("text", F.xxhash64("doc_id", "text").alias("h")).orderBy("h").limit(SAMPLE_DOCS)
    )

    def run(batches):
        encode = encoder(tokenizer, False).encode
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [token_bytes(encode, t, end_id)[: 4 * SAMPLE_IDS] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    ids = [bytes(r[0]) for r in sample.select("text").mapInArrow(run, "ids binary").collect()]
    try:
        size = min(DICTIONARY_BYTES, sum(map(len, ids)) // 8)
        return zstandard.train_dictionary(size, ids, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=given)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=given)


@dataclass(frozen=True)
class TokenFiles:
    """A written set: its folder and its dictionary, which is also a file there."""

    spark: SparkSession
    folder: str
    dictionary: bytes

    def manifest(self) -> DataFrame:
        """``(part, file, n_docs, n_ids, before)``: the files in order, and ids before each.

        Sums run over blocks of files, then over blocks.
        """
        files = self.spark.read.parquet(f"{self.folder}/written").withColumn(
            "block", F.floor(F.col("part") / BLOCK)
        )
        earlier = (W.unboundedPreceding, -1)
        blocks = files.groupBy("block").agg(F.sum("n_ids").alias("n"))
        shifts = blocks.select(
            "block", F.sum("n").over(W.orderBy("block").rowsBetween(*earlier)).alias("shift")
        )
        inside = F.sum("n_ids").over(W.partitionBy("block").orderBy("part").rowsBetween(*earlier))
        before = F.coalesce("inside", F.lit(0)) + F.coalesce("shift", F.lit(0))
        return (
            files.withColumn("inside", inside)
            .join(shifts, "block")
            .select("part", "file", "n_docs", "n_ids", before.alias("before"))
        )


def write(
    docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None
) -> TokenFiles:
    """Write whole texts as token files in ascending order of ``doc_id``, null ids first.

    Rows with one id follow in order of a hash of the text. A null text is its end id alone; an
    empty table writes no file. Every attempt of a task writes a file of its own name, and the
    table of files has those that Spark took, so a lost executor leaves nothing half.
    """
    spark = docs.sparkSession
    folder = shared_uri(folder or scratch(spark, "token-files"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train(rows, tokenizer, end_id)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(
        int(chars // FILE_CHARS + 1), "doc_id", "tie"
    )
    ordered = ranged.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches):
        encode, shrink = encoder(tokenizer, False).encode, compressor(dictionary).compress
        files, base = pafs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4().hex}.tid"
        index, nulls, end, total, out = [], bytearray(), len(MAGIC), 0, None
        for batch in batches:
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
            ):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}")
                    out.write(MAGIC)
                ids = token_bytes(encode, text.as_py(), end_id)
                frame = shrink(ids)
                out.write(frame)
                end, total = end + len(frame), total + len(ids) // 4
                index.append((doc_id or 0, end, total))
                nulls.append(doc_id is None)
        if out is not None:
            out.write(np.array(index, dtype="<i8").tobytes() + bytes(nulls))
            out.write(struct.pack(FOOT, digest(dictionary), len(index), total, MAGIC))
            out.close()
            row = (TaskContext.get().partitionId(), name, len(index), total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in row], ["part", "file", "n_docs", "n_ids"]
            )

    written = ordered.mapInArrow(run, "part long, file string, n_docs long, n_ids long")
    written.write.parquet(f"{folder}/written")
    files, base = pafs.FileSystem.from_uri(folder)
    with files.open_output_stream(f"{base}/dictionary") as out:
        out.write(dictionary)
    return TokenFiles(spark, folder, dictionary)


class Reader:
    """One file: its index is read at once, frames when they are asked for."""

    def __init__(self, uri: str, dictionary: bytes) -> None:
        files, path = pafs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        mark, n, self.n_ids, magic = struct.unpack(
            FOOT, self.file.read_at(FOOT_BYTES, size - FOOT_BYTES)
        )
        if magic != MAGIC or mark != digest(dictionary):
            raise ValueError(f"{uri} was not written with this dictionary")
        tail = self.file.read_at(25 * n, size - FOOT_BYTES - 25 * n)
        self.doc_ids, self.ends, self.totals = (
            np.frombuffer(tail, "<i8", 3 * n).reshape(n, 3).T if n else np.empty((3, 0), "<i8")
        )
        self.nulls = np.frombuffer(tail, np.uint8, n, 24 * n).astype(bool)
        self.unzip = decompressor(dictionary).decompress

    def ids(self, k: int) -> np.ndarray:
        """The ids of the file's ``k``-th document, from its frame alone."""
        begin = int(self.ends[k - 1]) if k else len(MAGIC)
        frame = self.file.read_at(int(self.ends[k]) - begin, begin)
        return np.frombuffer(self.unzip(frame), "<u4")

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.totals[:-1]])


def read(written: TokenFiles) -> DataFrame:
    """``(doc_id, start, ids)`` from the files; ``start`` counts the ids of all documents before."""
    folder, dictionary = written.folder, written.dictionary
    listed = stored(written.manifest(), "token-manifest")
    spread = listed.repartition(max(1, listed.count()), "part").select("file", "before")

    def run(batches):
        for batch in batches:
            for file, before in zip(
                batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True
            ):
                one = Reader(f"{folder}/{file}", dictionary)
                starts = one.starts() + before
                for a in range(0, len(starts), 500):
                    b = min(a + 500, len(starts))
                    ids = [one.ids(k).tobytes() for k in range(a, b)]
                    names = pa.array(one.doc_ids[a:b], mask=one.nulls[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array(starts[a:b]), pa.array(ids, pa.binary())],
                        ["doc_id", "start", "ids"],
                    )

    return spread.mapInArrow(run, "doc_id long, start long, ids binary")
