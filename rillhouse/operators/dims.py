"""Dimension tables: cell-wise upsert, and a store of snapshots and deltas.

A stored row keeps, beside each cell, the sequence number that wrote it. Merging takes the cell
with the highest number per column, so it gives the same result in any order and for any number of
repeats; a replayed micro-batch does no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.session import drop_folder, exists, run_of

_SEQ = "__seq_"
_STORED = "__k STRING, name STRING, seq BIGINT, cell STRING, table STRING"
#: A cell behind the number that wrote it, so that the greater pair is the newer one.
_PAIR = "struct(seq, cell)"


def upsert_cells(
    changes: DataFrame, key: str, cells: str, columns: Sequence[str], seq: str
) -> DataFrame:
    """Latest cell per key and column from change records holding a map of cells.

    A column missing from a record, or null in it, leaves the earlier cell in place. Partial
    aggregation keeps one candidate per task, key and column before the exchange.
    """
    rows = changes.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"),
        *[_stamped(F.col(seq), F.col(cells)[c]).alias(c) for c in columns],
    )
    return _newest(rows, columns)


def upsert_columns(
    changes: DataFrame, key: str, columns: Sequence[str], seq: str
) -> DataFrame:
    """The same for change records with plain columns: key plus latest non-null per column."""
    rows = changes.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"),
        *[_stamped(F.col(seq), F.col(c)).alias(c) for c in columns],
    )
    return cells_only(_newest(rows, columns), columns).withColumnRenamed("__k", key)


def _stamped(seq: Column, cell: Column) -> Column:
    """A cell behind the number that wrote it, so that the greater pair is the newer one."""
    return F.when(cell.isNotNull(), F.struct(seq.alias("s"), cell.alias("v")))


def _newest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    newest = rows.groupBy("__k").agg(*[F.max(c).alias(c) for c in columns])
    return newest.select(
        "__k",
        *[F.col(f"{c}.v").alias(c) for c in columns],
        *[F.col(f"{c}.s").alias(f"{_SEQ}{c}") for c in columns],
    )


def cells_only(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select("__k", *columns)


class DimStore:
    """Dimension tables below one folder: cells with the numbers that wrote them.

    A stored row is one cell, ``(table, key, column, number, cell)``, so a table holds every column
    that any rule ever wrote, and all tables of a micro-batch leave in one write. A batch is a
    delta named by its stream and number: neither a second job nor a fresh checkpoint meets it, and
    a batch that comes again finds it finished. ``compact`` folds what is there into a snapshot
    whose list names the deltas it holds; a reader merges the newest listed snapshot with all other
    deltas, in whatever order they were written. Nothing is changed in place, and what a snapshot
    replaced goes one compaction later.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create_if_absent(
        self, table: str, columns: Sequence[str] | T.StructType, extend: str | None = None
    ) -> None:
        """Declare a table, as text columns unless given typed; a declared one stays as it is.

        ``extend`` is kept with the declaration as the comment of its first column.
        """
        path = f"{self.root}/declared/{table}"
        if exists(self.spark, f"{path}/_SUCCESS"):
            return
        if not isinstance(columns, T.StructType):
            columns = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        first = columns.fields[0]
        noted = T.StructField(first.name, first.dataType, first.nullable, {"comment": extend or ""})
        schema = T.StructType([noted, *columns.fields[1:]])
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)

    def declared(self, table: str) -> T.StructType:
        return self.spark.read.parquet(f"{self.root}/declared/{table}").schema

    def upsert(
        self,
        table: str,
        batch_id: int,
        changes: DataFrame,
        key: str,
        cells: str,
        columns: Sequence[str],
        seq: str,
        run: str | None = None,
    ) -> None:
        """One batch of one table; of the map ``cells`` the named columns count."""
        self.create_if_absent(table, columns)
        chosen = F.map_filter(cells, lambda name, _: name.isin(list(columns)))
        rows = changes.select(
            F.lit(table).alias("table"),
            F.col(key).alias("key"),
            chosen.alias("cells"),
            F.col(seq).alias("seq"),
        )
        self.upsert_all(rows, batch_id, run or run_of(changes))

    def upsert_all(self, changes: DataFrame, batch_id: int, run: str) -> None:
        """One batch of any tables, from ``(table, key, cells, seq)``. Null cells leave the earlier
        ones in place; rows without a key are left out."""
        path = self._path("delta", f"{run}-{batch_id}")
        if exists(self.spark, f"{path}/_SUCCESS"):
            return
        # an entry without a name says that the key exists
        known = F.map_concat("cells", F.create_map(F.lit(""), F.lit("")))
        rows = changes.where("key IS NOT NULL").select(
            "table",
            F.col("key").cast("string").alias("__k"),
            F.col("seq").cast("long").alias("seq"),
            F.explode(known).alias("name", "cell"),
        )
        self._newest(rows.where("cell IS NOT NULL")).write.mode("overwrite").partitionBy(
            "table"
        ).parquet(path)

    def read(self, table: str, columns: Sequence[str], key: str = "ID") -> DataFrame:
        """Current rows: the key as ``key`` and the asked-for cells; a column never written is
        null."""
        wanted = [c for c in columns if c != key]
        if not exists(self.spark, f"{self.root}/declared/{table}/_SUCCESS"):
            raise ValueError(f"no such dimension: {table}")
        rows = self._rows()
        if rows is None:
            fields = [T.StructField(c, T.StringType()) for c in (key, *wanted)]
            return self.spark.createDataFrame([], T.StructType(fields))
        newest = rows.where(F.col("table") == table).groupBy(F.col("__k").alias(key)).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.max(F.when(F.col("name") == c, F.expr(_PAIR))).alias(c) for c in wanted],
        )
        return newest.select(key, *[F.col(f"`{c}`.cell").alias(c) for c in wanted])

    def compact(self) -> None:
        """Fold all finished deltas of all tables into a new snapshot, and drop what the snapshot
        before had replaced."""
        listed = self._listed()
        last = max(listed, default=-1)
        held = set(listed.get(last, ()))
        fresh = [v for v in self._finished("delta") if v not in held]
        if not fresh:
            return
        number = last + 1
        self._newest(self._rows()).write.mode("overwrite").partitionBy("table").parquet(
            self._path("base", number)
        )
        self.spark.createDataFrame(
            [(v,) for v in sorted(held & set(self._finished("delta"))) + fresh], "v STRING"
        ).coalesce(1).write.mode("overwrite").parquet(self._path("folded", number))
        for old in [v for v in listed if v < last]:
            drop_folder(self.spark, self._path("folded", old))
            drop_folder(self.spark, self._path("base", old))
        for old in held:
            drop_folder(self.spark, self._path("delta", old))

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        best = rows.groupBy("table", "__k", "name").agg(F.max(F.expr(_PAIR)).alias("p"))
        return best.select("__k", "name", "p.seq", "p.cell", "table")

    def _rows(self) -> DataFrame | None:
        """Cells of the newest snapshot and of all deltas that it does not hold."""
        listed = self._listed()
        last = max(listed, default=None)
        held = set(listed.get(last, ()))
        paths = [self._path("delta", v) for v in self._finished("delta") if v not in held]
        if last is not None:
            paths.append(self._path("base", last))
        frames = [self.spark.read.schema(_STORED).parquet(p) for p in paths]
        return reduce(DataFrame.union, frames) if frames else None

    def _listed(self) -> dict[int, list[str]]:
        """Snapshots by number, with the names of the deltas they hold: one row per batch since
        the compaction before."""
        found = {}
        numbers = sorted(map(int, self._finished("folded")))
        for n in numbers[-2:]:
            rows = self.spark.read.parquet(self._path("folded", n)).collect()
            found[n] = [r[0] for r in rows]
        return {**{n: [] for n in numbers[:-2]}, **found}

    def _path(self, kind: str, version: int | str) -> str:
        return f"{self.root}/{kind}/v={version}"

    def _finished(self, kind: str) -> list[str]:
        """Names of completely written versions."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/v=*/_SUCCESS")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(path) or []
        return [f.getPath().getParent().getName().removeprefix("v=") for f in found]
