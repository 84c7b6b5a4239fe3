"""A sink whose batches count as a whole or not at all.

Tasks write files that nobody reads yet and tell the driver their names. A batch's names are put down
in one file, named by the batch's number; from then on its rows are part of the table. A batch that
fails leaves no row, one that comes again adds none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from rillhouse.sources.positions import opened


@dataclass
class Written(WriterCommitMessage):
    """A task's file, or none, and its rows."""

    name: str | None
    rows: int


class BatchWriter(DataSourceStreamArrowWriter):
    """Files below ``rows``, and a list of them for each batch below ``batches``."""

    def __init__(self, options: dict[str, str], names: list[str]) -> None:
        self.path = options["path"].rstrip("/")
        left_out = {c for c in options.get("transient", "").split(",") if c}
        if left_out - set(names):
            raise ValueError(f"not in the record: {sorted(left_out - set(names))}")
        self.names = [n for n in names if n not in left_out]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = opened(self.path)
        files.create_dir(f"{root}/rows", recursive=True)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                kept = batch.select(self.names)
                if len(kept):
                    if out is None:
                        out = pq.ParquetWriter(f"{root}/rows/{name}", kept.schema, filesystem=files)
                    out.write_batch(kept)
                    rows += len(kept)
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files, root = opened(self.path)
        done = f"{root}/batches/{batchId}.json"
        if files.get_file_info(done).type != pafs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        files.create_dir(f"{root}/batches", recursive=True)
        found = [(m.name, m.rows) for m in messages if m is not None and m.name]
        staged = f"{root}/batches/_{batchId}-{uuid.uuid4().hex}"
        with files.open_output_stream(staged) as out:
            out.write(json.dumps(dict(found)).encode())
        files.move(staged, done)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        files, root = opened(self.path)
        for m in messages:
            if m is not None and m.name:
                files.delete_file(f"{root}/rows/{m.name}")


class CommittedBatches(DataSource):
    """``writeStream.format("committed_batches")`` with a ``path``; the option ``transient`` names
    fields that are not written."""

    @classmethod
    def name(cls) -> str:
        return "committed_batches"

    def streamWriter(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options, schema.names)


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all batches that count; files of others are not opened."""
    listed = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json")
    names = listed.text(f"{path}/batches").selectExpr(
        "explode(map_keys(from_json(value, 'map<string,long>'))) AS name"
    )
    paths = [f"{path}/rows/{r.name}" for r in names.toLocalIterator()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
