"""Helpers that the operators of this folder share."""

from __future__ import annotations

import os
import shutil
import tempfile
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.session import scratch

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()

#: A side of at most this many bytes may be sent to every executor.
BROADCAST_BYTES = 8 << 20


#: Rows of one Arrow batch where the session has Spark's default of 10,000: texts may be long.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, unless they find it by their path as the driver does.

    Call it before functions of the package go into a plan; an installed package needs none. It
    also lowers the rows of an Arrow batch, unless the session has a value of its own.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.master.startswith("local"):
        paths.append(os.getcwd())
    found = any(p and os.path.realpath(p) == os.path.realpath(root) for p in paths)
    if found or context.applicationId in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="rillhouse-")
    made = shutil.make_archive(os.path.join(folder, "rillhouse"), "zip", root, "rillhouse")
    context.addPyFile(made)
    _SHIPPED.add(context.applicationId)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within it, jobs send workers at most so many rows at once; for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(
    df: DataFrame, label: str, codec: str | None = None, group_bytes: int | None = None
) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here.

    Name ``group_bytes`` where rows are large: a reader holds up to 4,096 rows of a row group at once
    and a page of 100 rows at least, unless row groups end at so many bytes and each row is looked at.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    options = {}
    if group_bytes is not None:
        options = {"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 1}
    df.write.options(**options).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> int:
    """Upper estimate of the bytes of a row: text columns are measured, others are fixed."""
    fixed = 16 + 16 * len(df.columns)
    texts = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    if not texts:
        return fixed
    longest = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first()
    return fixed + sum(v or 0 for v in longest)


def shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that Spark sorts and never broadcasts.

    Spark takes a table to be as large as its files, which are compressed, and does not count the
    rows that an explode adds. What it broadcasts by that passes through the driver.
    """
    return side.hint("merge")


def sized(side: DataFrame, n_bytes: int | None = None) -> DataFrame:
    """A side of a join that is ``shuffled``, unless its bytes are within ``BROADCAST_BYTES``.

    Without ``n_bytes``, ``side`` is measured and must be stored.
    """
    measured = side.count() * row_bytes(side) if n_bytes is None else n_bytes
    return side if measured <= BROADCAST_BYTES else shuffled(side)


def unused(base: str, *sides: DataFrame) -> str:
    """A column name that none of the tables has, in any case."""
    taken = {c.lower() for side in sides for c in side.columns}
    while base.lower() in taken:
        base += "_"
    return base


def lookup(
    facts: DataFrame, small: DataFrame, key: str, how: str = "left", salts: int = 32
) -> DataFrame:
    """``facts`` with the columns of ``small``, whose ``key`` is unique; nulls meet nulls.

    ``small`` must be stored. It is broadcast if its measured size is within ``BROADCAST_BYTES``;
    otherwise its rows are repeated over ``salts`` salts and both sides are shuffled, so that a key
    with a third of all facts meets in ``salts`` tasks. Both ways give the same rows.
    """
    its_key, salt, other = (unused(n, facts, small) for n in ("_key", "_salt", "_right"))
    right = small.withColumnRenamed(key, its_key)
    same = facts[key].eqNullSafe(F.col(its_key))
    if small.count() * row_bytes(small) <= BROADCAST_BYTES:
        return facts.join(F.broadcast(right), same, how).drop(its_key)
    salted = facts.withColumn(salt, F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
    right = right.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # the copies of its rows are not in what Spark takes for its size
    return salted.join(
        shuffled(right),
        salted[key].eqNullSafe(F.col(its_key)) & (F.col(salt) == F.col(other)),
        how,
    ).drop(its_key, salt, other)


def tidy(run):
    """A map over Arrow batches that gives back the memory it held when its task ends."""

    def mapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return mapped


#: About so many links of a graph make up one task.
LINKS_PER_TASK = 200_000


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for each node of the undirected ``links(a, b)``.

    A component's root is its smallest node.

    Each round points every node at its smallest neighbour, follows the pointers to their ends by
    doubling, and replaces links by links between the ends. An end always stands for two nodes at
    least, so rounds are logarithmic. All tables stay in the shared folder; they never have more
    rows than twice the links, whose count sets the number of tasks.
    """
    first = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct(),
        label,
    )
    left = first.count()
    tasks = left // LINKS_PER_TASK + 1
    live, roots = first, None

    def side(ends: DataFrame) -> DataFrame:
        return sized(ends, 2 * left * row_bytes(ends))

    while left:
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("up"))
        up = stored(up.coalesce(tasks), label)
        moved = True
        while moved:
            two = up.join(side(up.toDF("up", "two")), "up")
            up = stored(two.join(side(up.toDF("two", "three")), "two")
                        .select("node", "two", "three").coalesce(tasks), label)
            moved = not up.where("two <> three").isEmpty()
            up = up.select("node", F.col("three").alias("up"))
        live = stored(
            live.join(side(up.toDF("a", "ra")), "a")
            .join(side(up.toDF("b", "rb")), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
            .coalesce(tasks),
            label,
        )
        further = side(up.toDF("root", "next"))
        left = live.count()
        if roots is None:
            roots = up.toDF("node", "root")
        else:
            roots = roots.join(further, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")
            )
            roots = stored(roots.coalesce(tasks), label)
    return first.toDF("node", "root") if roots is None else roots
