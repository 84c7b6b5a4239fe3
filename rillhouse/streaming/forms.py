"""Stream forms of the operators, for inputs with an event-time column.

Interval joins, dimension lookups, splits and the theme aggregates have no form of their own here:
their DataFrame expressions serve streams as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.functions.scalar import micros, time_cell
from rillhouse.operators.ordered import DAY
from rillhouse.operators.themes import span_text
from rillhouse.streaming import processors

cloudpickle.register_pickle_by_value(processors)

MONOTONE = timedelta(0)
PATTERN_LATENESS = timedelta(seconds=2)


def watermarked(df: DataFrame, ts: str, lateness: timedelta = MONOTONE) -> DataFrame:
    """Event time with a bound on how late records may come; zero for ordered input."""
    return df.withWatermark(ts, span_text(lateness))


def count_with_timeout(
    df: DataFrame, key: str, ts: str, gap: timedelta = timedelta(milliseconds=100)
) -> DataFrame:
    """Records per key until ``gap`` passes without one; also usable on batches.

    The built-in window still joins a record that comes exactly at its end, so it is taken one
    microsecond, the resolution of time, short of ``gap``.
    """
    tick = timedelta(microseconds=1)
    span = F.session_window(ts, span_text(gap - tick))
    return (
        df.groupBy(key, span.alias("s"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            key,
            F.col("s.start").alias("session_start"),
            (F.col("s.end") + F.lit(tick)).alias("session_end"),
            "n",
        )
    )


def first_per_day(
    df: DataFrame, key: str, ts: str, where: Column | None = None, day: str = "day"
) -> DataFrame:
    """The first record to arrive for each key and calendar day.

    A day's key is forgotten one day of event time after that record, when no record of the same
    day can count any more.
    """
    rows = df if where is None else df.where(where)
    timed = rows.withColumn(day, F.to_date(ts)).withWatermark(ts, "1 day")
    return timed.dropDuplicatesWithinWatermark([key, day])


def correct_new_flag(
    df: DataFrame,
    key: str,
    flag: str,
    ts: str,
    tie: str,
    new: str = "1",
    old: str = "0",
    ttl: timedelta | None = None,
) -> DataFrame:
    """Only the first record flagged new keeps its flag. Other records do not enter the state.

    A ``ttl`` is counted in processing time. Such a stream always has another batch to run, so it
    needs a periodic trigger and is not for draining a bounded input.
    """
    is_new = F.coalesce(F.col(flag) == new, F.lit(False))
    ttl_ms = None if ttl is None else ttl // timedelta(milliseconds=1)
    judged = (
        df.where(is_new)
        .groupBy(key)
        .transformWithState(
            statefulProcessor=processors.NewFlag(flag, [ts, tie], new, old, ttl_ms),
            outputStructType=df.schema,
            outputMode="Append",
            timeMode="None" if ttl is None else "ProcessingTime",
        )
    )
    return judged.unionByName(df.where(~is_new))


def running(
    df: DataFrame, key: str, ts: str, tie: str, sums: Mapping[str, Column]
) -> DataFrame:
    """Running whole-number sums per key, one output per record."""
    names = list(sums)
    values = [f"__v_{n}" for n in names]
    rows = df.drop(*names).withColumns(
        {v: e.cast("long") for v, e in zip(values, sums.values())}
    )
    out = T.StructType([f for f in rows.schema.fields if f.name not in values])
    for name in names:
        out = out.add(name, T.LongType())
    return rows.groupBy(key).transformWithState(
        statefulProcessor=processors.Running([ts, tie], values, names),
        outputStructType=out,
        outputMode="Append",
        timeMode="None",
    )


def entry_pattern(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    entry: Column,
    horizon: timedelta,
    keep: list[str],
    lateness: timedelta = PATTERN_LATENESS,
    cell: timedelta | None = None,
) -> DataFrame:
    """Stream form of the entry pattern; gives the columns in ``keep`` and ``how``.

    Records gather in windows of ``cell`` per key. A record in the first ``horizon`` of a window
    also enters the window before, dated ``horizon`` earlier, so that a window holds every
    successor its records can have; the watermark waits ``horizon`` longer for the same reason.
    When a window closes, its records are put in order and decided by built-in array functions.
    What gathers is one key's traffic of one window, a minute by default.
    """
    cell = cell or max(6 * horizon, timedelta(minutes=1))
    if cell < horizon:
        raise ValueError("cell narrower than the horizon")
    early = F.unix_micros(ts) - time_cell(ts, cell) < micros(horizon)
    own = F.struct(F.col(ts).alias("at"), F.lit(True).alias("mine"))
    before = F.struct((F.col(ts) - F.lit(horizon)).alias("at"), F.lit(False).alias("mine"))
    copies = F.when(early, F.array(own, before)).otherwise(F.array(own))
    rows = (
        df.select(
            F.col(key).alias("__key"),
            F.inline(copies),
            F.struct(
                F.unix_micros(ts).alias("us"),
                F.col(tie).alias("tie"),
                F.coalesce(entry, F.lit(False)).alias("entry"),
                F.struct(*keep).alias("kept"),
            ).alias("__e"),
        )
        .withColumn("__e", F.col("__e").withField("mine", F.col("mine")))
        .withWatermark("at", span_text(lateness + horizon))
    )
    closed = rows.groupBy(F.window("at", span_text(cell)), "__key").agg(
        F.array_sort(F.collect_list("__e")).alias("es")
    )
    step = F.transform(
        "es", lambda e, i: F.struct(e.alias("e"), F.get("es", i + 1).alias("n"))
    )

    def near(p: Column) -> Column:
        gap = p["n"]["us"] - p["e"]["us"]
        return F.coalesce(gap < micros(horizon), F.lit(False))

    left = F.filter(
        step, lambda p: p["e"]["mine"] & p["e"]["entry"] & (~near(p) | p["n"]["entry"])
    )
    pair = F.col("p")
    return closed.select(F.explode(left).alias("p")).select(
        "p.e.kept.*", F.when(near(pair), "match").otherwise("timeout").alias("how")
    )


def entry_pattern_timed(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    entry: Column,
    horizon: timedelta,
    keep: list[str],
    lateness: timedelta = PATTERN_LATENESS,
    cell: timedelta | None = None,
    buckets: int = 256,
) -> DataFrame:
    """The same by event-time timers, for results within the horizon instead of within a window.

    Calls from a Python worker to the state store are many times slower than the windowed form, so
    keys share ``buckets``: calls are made for the records of a bucket and not for each record.

    State is kept per bucket and time cell, and each cell also sees the first ``horizon`` of the next
    one, as in the batch form: a hot key is spread and a finished cell leaves no state.
    """
    cell = cell or max(16 * horizon, DAY)
    own = time_cell(ts, cell)
    early = F.unix_micros(ts) - own < micros(horizon)
    mine = F.col("__own") == F.col("__cell")
    rows = watermarked(df, ts, lateness).select(
        "*", F.coalesce(entry, F.lit(False)).alias("__entry"), own.alias("__own"),
        early.alias("__early"),
    )
    rows = rows.withColumn(
        "__cell",
        F.explode(
            F.when(
                F.col("__early"), F.array(F.col("__own"), F.col("__own") - micros(cell))
            ).otherwise(F.array(F.col("__own")))
        ),
    )
    lead = [F.pmod(F.xxhash64(key), F.lit(buckets)).alias("__bucket"), F.col("__cell"), F.col(ts)]
    rows = rows.select(
        *lead,
        F.unix_micros(ts).alias("__us"),
        F.col(tie).cast("long").alias("__tie"),
        "__entry",
        mine.alias("__mine"),
        F.col(key).alias("__key"),
        # only entries of this cell are given out
        *[F.when(F.col("__entry") & mine, F.col(c)).alias(f"__c{i}") for i, c in enumerate(keep)],
    )
    kept = T.StructType([df.schema[c] for c in keep])
    out = T.StructType(list(kept.fields)).add("how", T.StringType())
    return rows.groupBy("__bucket", "__cell").transformWithState(
        statefulProcessor=processors.EntryPattern(list(keep), len(lead), micros(horizon)),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )
