"""Streaming sources that keep a position of their own: topic folders by file and byte, tables by row.

Both bound what one micro-batch takes. The engine writes a batch's end position to the checkpoint
before it runs, so a stream that is started again goes on where it was and repeats a batch that was
cut off with exactly the same records. The driver lists files and reads footers; data are read by
the tasks only. The sources are shipped to the workers by value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Most that one micro-batch and one task take, unless the options name other limits.
BYTES_PER_BATCH, BYTES_PER_TASK = 1 << 30, 16 << 20
ROWS_PER_BATCH = 10_000_000
# A record's offset is the number of its file in the queue and its first byte in the file.
FILE_BITS = 40


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def natural(path: str) -> list:
    """Numbers within a path count as numbers: batch 10 comes after batch 9."""
    return [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", path)]


def data_files(files: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    """Files below a folder in their natural order, without those that writers hide."""
    found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True))
    shown = [
        f for f in found
        if f.is_file and f.size and not re.search(r"(^|/)[_.]", f.path[len(folder):])
    ]
    return sorted(shown, key=lambda f: natural(f.path))


@dataclass
class Stretch(InputPartition):
    """Bytes of one file; the lines that begin within them are the task's."""

    path: str
    begin: int
    end: int
    number: int
    topic: str
    run: str
    written: int


class TopicReader(DataSourceStreamReader):
    """A queue is one run of one topic; its files are read in their natural order.

    The position of a queue is ``[files done, bytes of the next one, the last file's path]``. A
    queue only grows at its end: a file that comes to lie before the position fails the stream
    instead of being passed over.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")
        self.topics = [t for t in options["topics"].split(",") if t]
        self.most = int(options.get("bytesperbatch", BYTES_PER_BATCH))
        self.task = int(options.get("bytespertask", BYTES_PER_TASK))
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {}

    def queues(self) -> dict[str, list[pafs.FileInfo]]:
        files, root = opened(self.root)
        held: dict[str, list[pafs.FileInfo]] = {}
        for topic in self.topics:
            for f in data_files(files, f"{root}/topic={topic}"):
                run = re.search(r"/run=([^/]*)/", f.path)
                held.setdefault(f"{topic}/{run.group(1) if run else ''}", []).append(f)
        return held

    def latestOffset(self) -> dict:
        """The position after at most ``most`` bytes more, the same share for each queue."""
        held, at = self.queues(), dict(self.at or {})
        waiting = [q for q, files in held.items() if at.get(q, [0])[0] < len(files)]
        for queue in waiting:
            files, (done, byte, _) = held[queue], checked(held[queue], at.get(queue))
            left = max(1, self.most // len(waiting))
            while left > 0 and done < len(files):
                size = files[done].size
                step = min(left, size - byte)
                left, byte, last = left - step, byte + step, files[done].path
                if byte == size:
                    done, byte = done + 1, 0
            at[queue] = [done, byte, last]
        return at

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.at = end
        held, out = self.queues(), []
        for queue, (done, byte, _) in end.items():
            topic, run = queue.split("/", 1)
            files = held[queue]
            first, begin, _ = checked(files, start.get(queue))
            checked(files, end[queue])
            for number in range(first, done + (byte > 0)):
                f = files[number]
                stop = byte if number == done else f.size
                for a in range(begin, stop, self.task):
                    out.append(Stretch(f.path, a, min(stop, a + self.task), number, topic, run,
                                       f.mtime_ns // 1000))
                begin = 0
        return out

    def commit(self, end: dict) -> None:
        self.at = end

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.root)
        with files.open_input_file(partition.path) as source:
            lines, places = lines_of(source, partition.begin, partition.end)
        n = len(lines)
        shift = partition.number << FILE_BITS
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([partition.topic] * n, pa.string()),
                pa.array([partition.run] * n, pa.string()),
                pa.array(lines, pa.string()),
                pa.array([partition.written] * n, pa.timestamp("us", tz="UTC")),
                pa.array([shift + p for p in places], pa.int64()),
            ],
            ["topic", "run", "value", "record_ts", "offset"],
        )


def checked(files: list[pafs.FileInfo], at: list | None) -> list:
    """A queue's position, if the files up to it are still the ones that were read."""
    done, byte, last = at or [0, 0, None]
    behind = done if byte else done - 1
    if last is not None and (behind >= len(files) or files[behind].path != last):
        raise ValueError(f"files before the position have changed; it was in {last}")
    return [done, byte, last]


def lines_of(source: pa.NativeFile, begin: int, end: int) -> tuple[list[str], list[int]]:
    """The lines whose first byte lies in ``[begin, end)``, and these bytes' positions."""
    low = max(begin - 1, 0)
    data = bytes(source.read_at(end - low, low))
    first = 0 if begin == 0 else data.find(b"\n") + 1
    if begin and not first:
        return [], []
    size = source.size()
    while not data.endswith(b"\n") and low + len(data) < size:
        more = bytes(source.read_at(min(1 << 16, size - low - len(data)), low + len(data)))
        cut = more.find(b"\n")
        data += more if cut < 0 else more[: cut + 1]
    if first >= end - low:
        return [], []
    raw = data[first:].removesuffix(b"\n").split(b"\n")
    places, at = [], low + first
    for line in raw:
        places.append(at)
        at += len(line) + 1
    return [line.removesuffix(b"\r").decode("utf-8", "replace") for line in raw], places


class TopicFiles(DataSource):
    """``spark.readStream.format("topic_files")`` with ``path`` and comma-separated ``topics``."""

    @classmethod
    def name(cls) -> str:
        return "topic_files"

    def schema(self) -> str:
        return "topic STRING, run STRING, value STRING, record_ts TIMESTAMP, offset LONG"

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(self.options)


@dataclass
class Rows(InputPartition):
    """Some rows of one row group, the first of which has the number ``value``."""

    path: str
    group: int
    skip: int
    take: int
    value: int


class RowReader(DataSourceStreamReader):
    """Numbers a table's rows; the position is how many were counted.

    Files count in their natural order, and new ones only after them. Footers tell where a row
    number lies, so the limit is in rows and no task reads rows that are not its own batch's.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("rowsperbatch", ROWS_PER_BATCH))
        self.number = options.get("number", "value")
        self.at: dict | None = None
        self.groups: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:
        return {"row": 0}

    def listed(self) -> list[tuple[str, list[int]]]:
        """The rows of each row group, by file; a file's footer is read once."""
        for path in table_files(self.path):
            if path not in self.groups:
                self.groups[path] = row_groups(self.path, path)
        return list(self.groups.items())

    def latestOffset(self) -> dict:
        total = sum(sum(groups) for _, groups in self.listed())
        done = (self.at or self.initialOffset())["row"]
        return {"row": max(done, min(total, done + self.most))}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        self.at = end
        out, first = [], 0
        for path, groups in self.listed():
            for group, n in enumerate(groups):
                low, high = max(start["row"], first), min(end["row"], first + n)
                if low < high:
                    out.append(Rows(path, group, low - first, high - low, low))
                first += n
        return out

    def commit(self, end: dict) -> None:
        self.at = end

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.path)
        value, skip, left = partition.value, partition.skip, partition.take
        with files.open_input_file(partition.path) as source:
            table = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            wanted = with_instants(table)
            for batch in table.iter_batches(row_groups=[partition.group]):
                part = batch.cast(wanted).slice(skip, left)
                skip = max(0, skip - len(batch))
                if len(part):
                    numbers = pa.array(range(value, value + len(part)), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [numbers, *part.columns], [self.number, *part.schema.names]
                    )
                value, left = value + len(part), left - len(part)
                if not left:
                    return


def table_files(path: str) -> list[str]:
    files, root = opened(path)
    if files.get_file_info(root).is_file:
        return [root]
    return [f.path for f in data_files(files, root)]


def row_groups(path: str, file: str) -> list[int]:
    files, _ = opened(path)
    with files.open_input_file(file) as source:
        footer = pq.read_metadata(source)
    return [footer.row_group(g).num_rows for g in range(footer.num_row_groups)]


def with_instants(table: pq.ParquetFile) -> pa.Schema:
    """A file's columns; those of the old 96-bit times, which have no zone, are instants."""
    old = {
        table.schema.column(i).name
        for i in range(len(table.schema))
        if table.schema.column(i).physical_type == "INT96"
    }
    instant = pa.timestamp("us", tz="UTC")
    return pa.schema(
        [pa.field(f.name, instant) if f.name in old else f for f in table.schema_arrow]
    )


class NumberedRows(DataSource):
    """``spark.readStream.format("numbered_rows")`` with the ``path`` of a Parquet table.

    Gives the table's columns behind ``value``, the number of the row from 0; the option
    ``number`` names that column otherwise.
    """

    @classmethod
    def name(cls) -> str:
        return "numbered_rows"

    def schema(self):
        from pyspark.sql import types as T
        from pyspark.sql.pandas.types import from_arrow_schema

        files, _ = opened(self.options["path"])
        with files.open_input_file(table_files(self.options["path"])[0]) as source:
            found = with_instants(pq.ParquetFile(source, coerce_int96_timestamp_unit="us"))
        table = from_arrow_schema(found, prefer_timestamp_ntz=True)
        number = self.options.get("number", "value")
        if number in found.names:
            raise ValueError(f"the table has a column {number}; name another for the numbers")
        return T.StructType([T.StructField(number, T.LongType()), *table.fields])

    def streamReader(self, schema) -> RowReader:
        return RowReader(self.options)
