"""Layer jobs as streaming queries, from text records to topics and dimension tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from rillhouse import schemas
from rillhouse.functions.scalar import micros, time_cell
from rillhouse.operators import ordered
from rillhouse.operators.cdc import (
    SINK_DIM,
    SINK_KAFKA,
    SINK_OLAP,
    UNMATCHED,
    drop_deletes,
    normalize_cdc,
    route_by_rules,
    sink_schema,
)
from rillhouse.operators.dims import DimStore
from rillhouse.operators.keyed import lookup_keyed, write_keyed
from rillhouse.operators.logs import is_entry, parse_all, route_log
from rillhouse.operators.themes import span_text, visitor_rows, visitor_stats
from rillhouse.operators.wide import (
    enrich_order_wide,
    merge_order_detail,
    merge_payment_order,
    prepare_orders,
    with_fallback_time,
)
from rillhouse.plans.dwm import (
    JUMP_HORIZON,
    TOPIC_ORDER_WIDE,
    TOPIC_PAYMENT_WIDE,
    TOPIC_UNIQUE_VISIT,
    TOPIC_USER_JUMP,
)
from rillhouse.plans.ods import base_db_lines
from rillhouse.session import run_of
from rillhouse.sources.readers import Endpoint
from rillhouse.sources.writers import (
    messages,
    routed_messages,
    topic_stream,
    write_batch_topics,
)
from rillhouse.streaming import forms
from rillhouse.streaming.held import Held, watermark
from rillhouse.streaming.run import adaptive, for_each_batch

# Snapshots are folded after this many batches.
COMPACT_EVERY = 50
TOPIC_UNMATCHED = "dwd_unmatched"


def base_log_job(
    lines: DataFrame, tie: str, target: Endpoint, checkpoint: str
) -> DataStreamWriter:
    """Raw log lines to the detail topics, new-visitor flags corrected. ``tie`` is the record's
    position in its source."""
    flat = parse_all(lines).select(
        "*", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new")
    )
    fixed = forms.correct_new_flag(flat, "mid", "is_new", "ts", tie)
    logs = fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
    return topic_stream(route_log(logs), target, checkpoint)


def base_db_job(
    changes: DataFrame,
    rules: Callable[[], DataFrame],
    seq: str,
    target: Endpoint,
    store: DimStore,
    checkpoint: str,
) -> DataStreamWriter:
    """Raw change records to topics and dimension tables.

    ``rules`` gives the rules in force and is called for every micro-batch, before its records
    are routed, so a rule change takes effect while the job runs and no record overtakes its rule.
    Records without a rule, and those of a dimension without its key, go to a topic of their own;
    so does, as it came, a text that is no change record.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        in_force = rules()
        routed = route_by_rules(
            drop_deletes(normalize_cdc(batch, unreadable="unreadable")), in_force
        )
        routed.persist()
        try:
            run = run_of(batch)
            dim = F.col("sink_type") == SINK_DIM
            keyless = dim & F.col("key_value").isNull()
            sent = routed.where(F.col("sink_type").isin(SINK_KAFKA, SINK_OLAP))
            lost = routed.where((F.col("sink_type") == UNMATCHED) | keyless)
            write_batch_topics(
                routed_messages(sent).unionByName(
                    lost.select(
                        F.lit(TOPIC_UNMATCHED).alias("topic"),
                        F.coalesce(
                            "unreadable", F.to_json(F.struct("table", "type", "after"))
                        ).alias("value"),
                    )
                ),
                target,
                batch_id,
                run,
            )
            # One row per dimension rule.
            for rule in in_force.where(F.col("sinkType") == SINK_DIM).collect():
                schema = sink_schema(rule.sinkColumns, rule.sinkPk)
                store.create_if_absent(rule.sinkTable, schema, rule.sinkExtend)
            rows = routed.where(dim).select(
                F.col("sink_table").alias("table"),
                F.col("key_value").alias("key"),
                F.col("after").alias("cells"),
                F.col(seq).alias("seq"),
            )
            store.upsert_all(rows, batch_id, run)
            if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                store.compact()
        finally:
            routed.unpersist()

    return for_each_batch(changes, work, checkpoint)


def records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of a topic that an earlier layer wrote, with the source's record time; null where
    the source has none, as a clock would give another at each replay."""
    rows = lines if "record_ts" in lines.columns else lines.withColumn(
        "record_ts", F.lit(None).cast("timestamp")
    )
    return rows.select("record_ts", F.from_json("value", schema).alias("__r")).select(
        "record_ts", "__r.*"
    )


def page_records(lines: DataFrame) -> DataFrame:
    """Log records of a page topic with their device and event time."""
    return records(lines, schemas.BASE_LOG).drop("record_ts").select(
        "*", F.col("common.mid").alias("mid"), F.timestamp_millis("ts").alias("event_ts")
    )


def _log_messages(logs: DataFrame, topic: str) -> DataFrame:
    return messages(logs.select(*schemas.BASE_LOG.fieldNames()), topic)


def ods_db_job(changes: DataFrame, target: Endpoint, checkpoint: str) -> DataStreamWriter:
    """Raw change records to normalised envelopes."""
    return topic_stream(base_db_lines(changes), target, checkpoint)


def unique_visit_job(pages: DataFrame, target: Endpoint, checkpoint: str) -> DataStreamWriter:
    """Page topic to the first visit of each device per day."""
    first = forms.first_per_day(page_records(pages), "mid", "event_ts", is_entry())
    return topic_stream(_log_messages(first, TOPIC_UNIQUE_VISIT), target, checkpoint)


def user_jump_job(pages: DataFrame, target: Endpoint, checkpoint: str) -> DataStreamWriter:
    """Page topic to the visits that were left at once."""
    found = forms.entry_pattern(
        page_records(pages), "mid", "event_ts", "ts", is_entry(), JUMP_HORIZON,
        schemas.BASE_LOG.fieldNames(),
    )
    return topic_stream(_log_messages(found, TOPIC_USER_JUMP), target, checkpoint)


def order_wide_job(
    orders: DataFrame,
    details: DataFrame,
    dimensions: Callable[[], Mapping[str, DataFrame]],
    as_of: str,
    target: Endpoint,
    checkpoint: str,
) -> DataStreamWriter:
    """Order and detail topics to complete wide orders."""
    info = prepare_orders(records(orders, schemas.ORDER_INFO).drop("record_ts"))
    detail = prepare_orders(records(details, schemas.ORDER_DETAIL).drop("record_ts"))
    wide = merge_order_detail(
        forms.watermarked(info, "event_ts"), forms.watermarked(detail, "event_ts")
    )
    return enrich_job(wide, dimensions, as_of, TOPIC_ORDER_WIDE, target, checkpoint)


def payment_wide_job(
    payments: DataFrame, wide: DataFrame, target: Endpoint, checkpoint: str
) -> DataStreamWriter:
    """Payment and wide order topics to wide payments."""
    paid = with_fallback_time(records(payments, schemas.PAYMENT_INFO), "record_ts")
    done = with_fallback_time(records(wide, schemas.ORDER_WIDE), "record_ts")
    merged = merge_payment_order(
        forms.watermarked(paid.drop("record_ts"), "event_ts"),
        forms.watermarked(done.drop("record_ts"), "event_ts"),
    )
    return topic_stream(
        messages(merged.drop("event_ts"), TOPIC_PAYMENT_WIDE), target, checkpoint
    )


def visitor_theme(unique_visits: DataFrame, jumps: DataFrame, pages: DataFrame) -> DataFrame:
    """Three topics to the visitor theme; write it with ``writers.jdbc_stream`` or as messages."""
    return visitor_stats(
        visitor_rows(page_records(unique_visits), page_records(jumps), page_records(pages))
    )


def dimension_job(
    changes: DataFrame,
    store: DimStore,
    table: str,
    key: str,
    cells: str,
    columns: list[str],
    seq: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Change records of one table into its dimension."""

    def work(batch: DataFrame, batch_id: int) -> None:
        store.upsert(table, batch_id, batch, key, cells, columns, seq)
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            store.compact()

    return for_each_batch(changes, work, checkpoint)


def first_job(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    per: timedelta | None = None,
    lateness: timedelta = timedelta(0),
) -> DataStreamWriter:
    """Records with ``first``: whether one is the first of its keys, over all micro-batches.

    The engine keeps one count for each combination of keys, a built-in aggregate that is combined
    per task before the shuffle. Where a batch's own count is the whole count, the keys are new, and
    the earliest record of the batch by ``ts`` and ``tie`` is the first. ``(*keys, ts, tie)`` must
    identify a record. With ``per``, there is a first for each such span of event time; a span's keys
    are forgotten once the latest time less ``lateness`` has passed it, and what comes later for it
    is never first.
    """
    at = None if per is None else time_cell(ts, per)
    cells = [] if at is None else ["__cell"]
    slim = rows.select(*keys, ts)
    if at is not None:
        slim = slim.withWatermark(ts, span_text(lateness))
    span = [] if per is None else [F.window(ts, span_text(per)).alias("__w")]
    counts = slim.groupBy(*keys, *span).agg(F.count(F.lit(1)).alias("__n"))
    cell = [] if per is None else [F.unix_micros("__w.start").alias("__cell")]
    counts = counts.select(F.struct(*keys, *cell).alias("__k"), "__n")
    shapes = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__r"))
    whole = shapes.schema["__r"].dataType
    both = shapes.select(
        "__r", F.lit(None).cast(counts.schema["__k"].dataType).alias("__k"),
        F.lit(None).cast("long").alias("__n"),
    ).unionByName(counts.select(F.lit(None).cast(whole).alias("__r"), "__k", "__n"))

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            records = batch.where("__r is not null").select("__r.*")
            if at is not None:
                records = records.withColumn("__cell", at)
            by = [*keys, *cells]
            named = [f"__k{i}" for i in range(len(by))]
            known = batch.where("__r is null").select(
                *[F.col(f"__k.{c}").alias(n) for c, n in zip(by, named, strict=True)], "__n"
            )
            own = records.groupBy(*by).agg(
                F.min(F.struct(ts, tie)).alias("__f"), F.count(F.lit(1)).alias("__own")
            )
            same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, named, strict=True)]
            fresh = own.join(known, reduce(and_, same)).where("__own = __n")
            firsts = fresh.select(
                *[F.col(c).alias(n) for c, n in zip(by, named, strict=True)],
                F.col(f"__f.{ts}").alias("__ts"), F.col(f"__f.{tie}").alias("__tie"),
            ).withColumn("first", F.lit(True))
            place = [F.col(ts).eqNullSafe(F.col("__ts")), F.col(tie).eqNullSafe(F.col("__tie"))]
            marked = records.join(firsts, reduce(and_, [*same, *place]), "left")
            write(
                marked.select(*rows.columns, F.coalesce("first", F.lit(False)).alias("first")),
                batch_id,
            )
        finally:
            batch.unpersist()

    return for_each_batch(both, work, checkpoint, mode="update")


def running_job(
    rows: DataFrame,
    key: str,
    ts: str,
    tie: str,
    sums: Mapping[str, Column],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    base: str | None = None,
) -> DataStreamWriter:
    """Running whole-number sums per key, continued over micro-batches; no Python sees a row.

    The engine keeps one total a key: a built-in aggregate, combined per task before the shuffle.
    Its new totals come along with the batch's records. What a key had before the batch is its
    total less the batch's own sum; the records themselves are summed up by (key, time cell) as in
    the batch form, so a key that holds half of a batch is spread over its cells. ``write`` gets the
    records with their sums; a batch that is repeated after a failure has the same ones.

    Records are in time order within a batch, and batches in the order of their arrival.

    ``base`` is a place that ``save_totals`` wrote: the job goes on from the totals of another one,
    whose state may have had any number of partitions. A batch only reads the buckets of its keys.
    """
    names = list(sums)
    values = {n: f"__v_{n}" for n in names}
    valued = rows.drop(*names).withColumns({values[n]: e.cast("long") for n, e in sums.items()})
    # an empty sum is null; a key's total is a number from its first record on
    totals = valued.groupBy(F.col(key).alias("__k")).agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"__t_{n}") for n, v in values.items()]
    )
    record = F.struct(*[F.col(f"`{c}`") for c in valued.columns])
    shape = valued.select(record.alias("r")).schema["r"].dataType
    both = valued.select(
        record.alias("__r"), F.lit(None).cast(valued.schema[key].dataType).alias("__k"),
        *[F.lit(None).cast("long").alias(f"__t_{n}") for n in names],
    ).unionByName(
        totals.select(F.lit(None).cast(shape).alias("__r"), "__k", *[f"__t_{n}" for n in names])
    )

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            records = batch.where("__r is not null").select("__r.*")
            known = batch.where("__r is null").select(
                F.col("__k").alias(key), *[F.col(f"__t_{n}").alias(n) for n in names]
            )
            if base is not None:
                known = known.persist()
                known = _with_base(known, base, key, names, valued.schema[key])
            own = {n: F.col(v) for n, v in values.items()}
            done = ordered.running(records, key, ts, tie, own, totals=known)
            write(done.drop(*values.values()), batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(both, work, checkpoint, mode="update")


def _with_base(
    totals: DataFrame, base: str, key: str, names: Sequence[str], field: T.StructField
) -> DataFrame:
    """A batch's totals and what the job before had summed up for their keys."""
    schema = T.StructType(
        [T.StructField("__b", field.dataType), *[T.StructField(n, T.LongType()) for n in names]]
    )
    before = lookup_keyed(totals, base, schema, key, "__b", {f"__b_{n}": n for n in names})
    # what the null key had is one row
    null = totals.sparkSession.read.schema(schema).parquet(f"{base}_null").first()
    given = {
        n: F.col(n) + F.when(F.col(key).isNull(), F.lit(null[n])).otherwise(
            F.coalesce(f"__b_{n}", F.lit(0))
        )
        for n in names
    }
    return before.select(key, *[total.alias(n) for n, total in given.items()])


def totals_of(spark: SparkSession, checkpoint: str, key: T.StructField, names: Sequence[str]):
    """``(key, *names)``: the totals that a running job keeps, read from its checkpoint's state."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    sums = ", ".join(f"`{n}`: bigint" for n in names)
    own = F.col("key").cast(T.StructType([T.StructField("k", key.dataType)]))
    cells = F.col("value").cast(f"struct<{sums}>")
    return state.select(own["k"].alias(key.name), cells.alias("t")).select(
        key.name, *[F.coalesce(F.col(f"t.`{n}`"), F.lit(0)).alias(n) for n in names]
    )


def save_totals(
    spark: SparkSession, checkpoint: str, key: T.StructField, names: Sequence[str], base: str
) -> None:
    """Hand a stopped running job's totals over: ``running_job`` with this ``base`` goes on from them.

    They lie by bucket of the key. A key that is null has a place of its own.
    """
    totals = totals_of(spark, checkpoint, key, names).withColumnRenamed(key.name, "__b")
    write_keyed(totals.where("__b is not null"), base, "__b")
    null = totals.where("__b is null")
    zero = spark.createDataFrame([(None, *[0] * len(names))], totals.schema)
    null.unionByName(zero).groupBy("__b").agg(*[F.sum(n).alias(n) for n in names]).write.parquet(
        f"{base}_null"
    )


def late_rows_job(
    rows: DataFrame,
    ts: str,
    width: timedelta,
    lateness: timedelta,
    write: Callable[[DataFrame, DataFrame, int], None],
    marks: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Records split into those in time for their window and those that come after it was closed.

    A window of ``width`` is closed for a batch if it ends at or before the watermark, which is the
    latest time of all earlier batches less ``lateness``: the rule by which windowed aggregates drop
    records. ``write`` gets both parts. The latest time is kept below ``marks``, one row a batch;
    a batch only reads the one before it, so that a repeated batch splits in the same way.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = None
            if batch_id:
                before = spark.read.schema("mark long").parquet(f"{marks}/{batch_id - 1}").first()[0]
            latest = batch.agg(F.max(F.unix_micros(ts))).first()[0]
            seen = [m for m in (before, latest) if m is not None]
            spark.createDataFrame([(max(seen, default=None),)], "mark long").coalesce(
                1
            ).write.mode("overwrite").parquet(f"{marks}/{batch_id}")
            mark = None if before is None else before - micros(lateness)
            closed = F.lit(False)
            if mark is not None:
                end = time_cell(ts, width) + F.lit(micros(width))
                closed = F.coalesce(end <= F.lit(mark), F.lit(False))
            write(batch.where(~closed), batch.where(closed), batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(rows, work, checkpoint)


def interval_job(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    lower: timedelta,
    upper: timedelta,
    pairs: Callable[[DataFrame, DataFrame], DataFrame],
    write: Callable[[DataFrame, int], None],
    held: str,
    checkpoint: str,
    lateness: timedelta = timedelta(0),
) -> DataStreamWriter:
    """Two streams joined in time, as two watermarked streams are by the engine.

    ``pairs`` joins rows of both sides, by an interval within ``lower`` and ``upper``, and may go on
    with what it finds. It gets the batch's rows with all that can meet them: those of the batch and
    those that earlier ones left in ``held``. Of a batch, only rows stay there that a row still to
    come may meet, where the engine's join puts every row into its state and takes it out again.

    The watermark is the least of both sides' latest times in earlier batches, less ``lateness``.
    Rows at or behind it are late and dropped, rows without a time meet nothing. A batch is read
    several times, so its source must give it again, as those that can be replayed do.
    """
    store, late = Held(held), micros(lateness)
    one, two = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
        for df, name in ((left, "__l"), (right, "__r"))
    )
    both = one.withColumn("__r", F.lit(None).cast(two.schema[0].dataType)).unionByName(
        two.withColumn("__l", F.lit(None).cast(one.schema[0].dataType))
    )
    # a row has one side, so of these times and tests one is null; how late a partner may be
    at = [F.unix_micros(F.col(f"__l.`{left_ts}`")), F.unix_micros(F.col(f"__r.`{right_ts}`"))]
    reach = [micros(upper), -micros(lower)]

    def waiting(mark: int | None) -> Column:
        if mark is None:
            return at[0].isNotNull() | at[1].isNotNull()
        return (at[0] + reach[0] > mark) | (at[1] + reach[1] > mark)

    def sides(rows: DataFrame) -> list[DataFrame]:
        return [rows.where(f"{side} is not null").select(f"{side}.*") for side in ("__l", "__r")]

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = adaptive(batch)
        before = store.before(spark, batch_id, 2)
        old = watermark(before.latest, late)
        tops = batch.agg(*[F.max(t) for t in at]).first()
        latest = before.after(tops)
        mark = watermark(latest, late)
        fresh = batch.where(at[0].isNotNull() | at[1].isNotNull())
        if old is not None:
            fresh = fresh.where((at[0] > old) | (at[1] > old))
        here = sides(fresh)
        earlier = store.read(spark, both.schema, before.kept)
        if earlier is None:
            found = pairs(*here)
        else:
            kept = sides(earlier.where(waiting(old)))
            found = pairs(here[0], here[1].unionByName(kept[1])).unionByName(
                pairs(kept[0], here[1])
            )
        write(found, batch_id)
        ends = [t + r for t, r in zip(tops, reach, strict=True) if t is not None]
        until = max(ends, default=None)
        if until is not None and (mark is None or until > mark):
            store.keep(fresh.where(waiting(mark)), batch_id)
        else:
            until = None
        store.note(spark, batch_id, before, latest, until, mark)

    return for_each_batch(both, work, checkpoint)


def closed_windows_job(
    rows: DataFrame,
    ts: str,
    width: timedelta,
    lateness: timedelta,
    write: Callable[[DataFrame, int], None],
    held: str,
    checkpoint: str,
) -> DataStreamWriter:
    """The records of windows of ``width``, each window's all at once when the watermark closes it.

    ``write`` can therefore apply any batch aggregate by window. A window is closed by the batch that
    moves the latest time less ``lateness`` to its end or beyond; what comes later for it is late and
    dropped, and so are records without a time. Records of open windows lie in ``held``; a batch that
    closes no window reads none of them. A batch is read several times, so its source must give it
    again, as those that can be replayed do.
    """
    store, late, span = Held(held), micros(lateness), micros(width)
    end = time_cell(ts, width) + F.lit(span)

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = adaptive(batch)
        before = store.before(spark, batch_id)
        old = watermark(before.latest, late)
        top = batch.agg(F.max(F.unix_micros(ts))).first()[0]
        latest = before.after([top])
        mark = watermark(latest, late)
        fresh = batch.where(F.col(ts).isNotNull())
        if old is not None:
            fresh = fresh.where(end > old)
        closed = fresh.where(F.lit(False) if mark is None else end <= mark)
        if old is not None and mark // span > old // span:
            earlier = store.read(spark, rows.schema, before.kept)
            if earlier is not None:
                closed = closed.unionByName(earlier.where((end > old) & (end <= mark)))
        write(closed, batch_id)
        until = None if top is None else top - top % span + span
        if until is not None and until > mark:
            store.keep(fresh.where(end > mark), batch_id)
        else:
            until = None
        store.note(spark, batch_id, before, latest, until, mark)

    return for_each_batch(rows, work, checkpoint)


def lookup_job(
    facts: DataFrame,
    path: str,
    schema: T.StructType,
    key: str,
    dim_key: str,
    columns: Mapping[str, str],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    buckets: int = 256,
) -> DataStreamWriter:
    """Facts with attributes of a keyed dimension as it is at each batch, of which only the buckets
    that the batch asks for are read."""

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(
                lookup_keyed(batch, path, schema, key, dim_key, columns, buckets=buckets), batch_id
            )
        finally:
            batch.unpersist()

    return for_each_batch(facts, work, checkpoint)


def enrich_job(
    wide: DataFrame,
    dimensions: Callable[[], Mapping[str, DataFrame]],
    as_of: str,
    topic: str,
    target: Endpoint,
    checkpoint: str,
) -> DataStreamWriter:
    """Joined orders to complete wide records, with the dimensions as they are at each batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        done = enrich_order_wide(batch, dimensions(), as_of).drop("event_ts")
        write_batch_topics(messages(done, topic), target, batch_id)

    return for_each_batch(wide, work, checkpoint)
