"""Per-key operators over time order, in batch form.

All of them define a result by the order of one key's records. A plain window over the key would
put a hot key into one task. They work per (key, time cell) instead and carry what must cross a
cell border separately: either the border rows are seen by both cells, or a small table with a few
rows per cell is combined per key. Cell widths are parameters; results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rillhouse.functions.scalar import micros, time_cell

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def first_per_day(
    df: DataFrame, key: str, ts: str, tie: str, where: Column | None = None, day: str = "day"
) -> DataFrame:
    """The first record of each key on each calendar day.

    The planner keeps only the best row of each group before the exchange (window group limit),
    so the shuffle carries at most one row per task and group.
    """
    rows = df if where is None else df.where(where)
    rows = rows.withColumn(day, F.to_date(ts))
    order = W.partitionBy(key, day).orderBy(ts, tie)
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def correct_new_flag(
    df: DataFrame, key: str, flag: str, ts: str, tie: str, new: str = "1", old: str = "0"
) -> DataFrame:
    """Let only the first record flagged new keep its flag; later ones become old.

    ``(key, ts, tie)`` must identify a record. Records not flagged new pass through without a
    shuffle. The join key is the identity of a record, so a hot key does not matter to it.
    """
    is_new = F.coalesce(F.col(flag) == new, F.lit(False))
    claims = df.where(is_new)
    order = W.partitionBy(key).orderBy(ts, tie)
    first = (
        claims.select(key, ts, tie)
        .withColumn("__n", F.row_number().over(order))
        .where("__n = 1")
        .select(
            F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.col(tie).alias("__tie")
        )
    )
    same = (
        F.col(key).eqNullSafe(F.col("__key"))
        & F.col(ts).eqNullSafe(F.col("__ts"))
        & F.col(tie).eqNullSafe(F.col("__tie"))
    )
    judged = claims.join(first.withColumn("__hit", F.lit(True)), same, "left").withColumn(
        flag, F.when(F.col("__hit"), F.lit(new)).otherwise(F.lit(old))
    )
    return judged.select(df.columns).unionByName(df.where(~is_new))


def entry_pattern(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    entry: Column,
    horizon: timedelta,
    cell: timedelta | None = None,
) -> DataFrame:
    """Entry records whose strict successor is an entry record, comes too late, or is missing.

    Adds ``how``: ``match`` if the successor is an entry less than ``horizon`` later, ``timeout``
    if there is no successor within ``horizon``. An entry followed within ``horizon`` by another
    kind of record is not part of the result.

    A successor matters only within ``horizon``, so each cell also sees the first ``horizon`` of
    the next one; with cells much wider than the horizon few rows are copied, and one exchange
    serves the whole operator.
    """
    cell = cell or max(16 * horizon, HOUR)
    if cell < horizon:
        raise ValueError("cell narrower than the horizon")
    at = F.unix_micros(ts)
    own = time_cell(ts, cell)
    early = at - own < micros(horizon)
    seen = (
        df.withColumn("__entry", F.coalesce(entry, F.lit(False)))
        .withColumn("__own", own)
        .withColumn(
            "__cell",
            F.explode(
                F.when(early, F.array(F.col("__own"), F.col("__own") - micros(cell))).otherwise(
                    F.array(F.col("__own"))
                )
            ),
        )
    )
    order = W.partitionBy(key, "__cell").orderBy(ts, tie)
    gap = F.lead(at).over(order) - at
    within = F.coalesce(gap < micros(horizon), F.lit(False))
    return (
        seen.withColumn("__within", within)
        .withColumn("__next_entry", F.lead("__entry").over(order))
        .where("__own = __cell AND __entry AND (NOT __within OR __next_entry)")
        .withColumn("how", F.when(F.col("__within"), "match").otherwise("timeout"))
        .drop("__entry", "__own", "__cell", "__within", "__next_entry")
    )


def running(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    sums: Mapping[str, Column],
    cell: timedelta = HOUR,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Running sums per key, one output row per record, the record itself included.

    ``totals`` may hold, per key and under the names of the sums, what a key has summed up with the
    records given here; what exceeds these was there before and enters every sum.

    Totals per (key, cell) are summed on the map side first; their prefix sums, one row per cell,
    are what crosses cell borders. Each enters its cell as a row before all others, so records
    and carried sums share one exchange on (key, cell) and no join is needed.
    """
    values = {name: f"__v_{name}" for name in sums}
    rows = df.drop(*sums).withColumns({values[n]: e for n, e in sums.items()}).withColumns(
        {"__cell": time_cell(ts, cell), "__record": F.lit(True)}
    )
    earlier = W.partitionBy(key).orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    cells = rows.groupBy(key, "__cell").agg(*[F.sum(v).alias(v) for v in values.values()])
    by_key = W.partitionBy(key)
    if totals is None:
        befores = {v: F.sum(v).over(earlier) for v in values.values()}
        wanted = "NOT __first"
    else:
        # a key's cells and its total meet in one row set; the total is the row without a cell
        given = totals.select(
            F.col(key), F.lit(None).cast("long").alias("__cell"),
            *[F.col(n).alias(v) for n, v in values.items()],
        )
        cells = cells.withColumn("__total", F.lit(False)).unionByName(
            given.withColumn("__total", F.lit(True))
        )
        own = {
            v: F.sum(F.when(~F.col("__total"), F.coalesce(v, F.lit(0)))).over(by_key)
            for v in values.values()
        }
        whole = {v: F.max(F.when(F.col("__total"), F.col(v))).over(by_key) for v in values.values()}
        seen = {
            v: F.coalesce(F.sum(F.when(~F.col("__total"), F.col(v))).over(earlier), F.lit(0))
            for v in values.values()
        }
        befores = {
            v: F.coalesce(whole[v] - own[v], F.lit(0)) + seen[v] for v in values.values()
        }
        wanted = "NOT __total"
    carried = (
        cells.withColumn("__first", F.row_number().over(by_key.orderBy("__cell")) == 1)
        .withColumns(befores)
        .where(wanted)
        .drop("__total")
        .withColumn("__record", F.lit(False))
    )
    absent = [f for f in rows.schema.fields if f.name not in carried.columns]
    carried = carried.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]
    ).drop("__first")
    here = (
        W.partitionBy(key, "__cell")
        .orderBy("__record", ts, tie)
        .rowsBetween(W.unboundedPreceding, 0)
    )
    running_sums = {n: F.coalesce(F.sum(v).over(here), F.lit(0)) for n, v in values.items()}
    out = [*[c for c in df.columns if c not in sums], *sums]
    return (
        rows.unionByName(carried).withColumns(running_sums).where("__record").select(*out)
    )


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: timedelta,
    cell: timedelta | None = None,
) -> DataFrame:
    """Count of records per activity session; a pause of ``gap`` or more ends a session.

    Gives the keys, ``session_start``, ``session_end`` (last record plus ``gap``) and ``n``.

    Sessions are found per (key, cell). Only the first and the last of a cell can continue across
    a border, so only those meet again per key, at most two rows per cell.
    """
    cell = cell or max(64 * gap, HOUR)
    keys = list(keys)
    pause = micros(gap)
    local = W.partitionBy(*keys, "__cell").orderBy("__us")
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, F.unix_micros(ts).alias("__us"), time_cell(ts, cell).alias("__cell")
    )
    opens = F.coalesce((F.col("__us") - F.lag("__us").over(local) >= pause).cast("int"), F.lit(1))
    parts = (
        rows.withColumn("__opens", opens)
        .withColumn(
            "__no", F.sum("__opens").over(local.rowsBetween(W.unboundedPreceding, 0))
        )
        .groupBy(*keys, "__cell", "__no")
        .agg(
            F.min("__us").alias("__s"), F.max("__us").alias("__e"), F.count(F.lit(1)).alias("__n")
        )
        .withColumn("__last", F.max("__no").over(W.partitionBy(*keys, "__cell")))
        .withColumn(
            "__group",
            F.when(
                (F.col("__no") > 1) & (F.col("__no") < F.col("__last")), F.col("__cell")
            ),
        )
    )
    merge = W.partitionBy(*keys, "__group").orderBy("__s")
    opens = F.coalesce((F.col("__s") - F.lag("__e").over(merge) >= pause).cast("int"), F.lit(1))
    return (
        parts.withColumn("__opens", opens)
        .withColumn(
            "__no", F.sum("__opens").over(merge.rowsBetween(W.unboundedPreceding, 0))
        )
        .groupBy(*keys, "__group", "__no")
        .agg(
            F.timestamp_micros(F.min("__s")).alias("session_start"),
            F.timestamp_micros(F.max("__e") + F.lit(pause)).alias("session_end"),
            F.sum("__n").alias("n"),
        )
        .select(*keys, "session_start", "session_end", "n")
    )
