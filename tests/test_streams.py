"""Stream forms over several micro-batches, restarts and late rows."""

import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillhouse.operators import cdc, dims
from rillhouse.operators.joins import interval_join
from rillhouse.operators.ordered import correct_new_flag, entry_pattern, running
from rillhouse.operators.themes import product_rows, product_stats, visitor_stats
from rillhouse.plans import facade
from rillhouse.session import stream_session
from rillhouse.sources.readers import Endpoint, counter_stream, text_batch, text_stream
from rillhouse.sources.writers import buffered_stream, console_stream, topic_stream
from rillhouse.streaming import forms, jobs
from rillhouse.streaming.run import finish, for_each_batch, start
from tests.conftest import at, rows
from tests.test_ordered import SCHEMA, made

KEEP = ["mid", "tie"]


@pytest.fixture(scope="module")
def session(spark):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


class Feed:
    """A folder of files read one per micro-batch."""

    def __init__(self, spark, session, path, schema):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0
        path.mkdir()
        self.stream = (
            session.readStream.schema(spark.createDataFrame([], schema).schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(f"{self.path}/*")
        )

    def put(self, data):
        df = self.spark.createDataFrame(data, self.schema).coalesce(1)
        df.write.parquet(f"{self.path}/{self.n:03d}")
        self.n += 1
        time.sleep(0.05)  # files are taken in the order of their times


def run(df, out, mode="append"):
    writer = (
        df.writeStream.format("parquet").outputMode(mode)
        .option("path", f"{out}/data").option("checkpointLocation", f"{out}/state")
    )
    finish(start(writer, "run", once=True))
    return lambda spark: spark.read.schema(df.schema).parquet(f"{out}/data")


def batches(data, n=3):
    """Time-ordered events cut into batches, shuffled within each."""
    data = sorted((r for r in data if r[0] is not None), key=lambda r: (r[1], r[2]))
    step = len(data) // n + 1
    return [data[i : i + step][::-1] for i in range(0, len(data), step)]


END = ("end", at(10_000_000), -1, False, "0", 0)


@pytest.mark.parametrize("form", [forms.entry_pattern, forms.entry_pattern_timed])
def test_entry_pattern_equals_batch(spark, session, tmp_path, form):
    horizon = timedelta(seconds=10)
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    data = made(600, span=4000)
    for part in batches(data):
        feed.put(part)
    feed.put([END])
    found = form(feed.stream, "mid", "ts", "tie", F.col("entry"), horizon, KEEP)
    got = run(found, tmp_path / "out")(spark)
    want = entry_pattern(
        spark.createDataFrame([r for r in data if r[0]], SCHEMA), "mid", "ts", "tie", F.col("entry"), horizon
    )
    assert rows(got, "tie", "how") == rows(want, "tie", "how")


@pytest.mark.parametrize("form", [forms.entry_pattern, forms.entry_pattern_timed])
def test_row_behind_the_watermark_changes_nothing(spark, session, tmp_path, form):
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    feed.put([("a", at(0), 1, True, "0", 0), ("a", at(5000), 2, True, "0", 0)])
    feed.put([("b", at(9000), 3, True, "0", 0)])
    # By now the first record is decided; this one would have broken its pattern.
    feed.put([("a", at(1), 4, False, "0", 0)])
    feed.put([END])
    found = form(feed.stream, "mid", "ts", "tie", F.col("entry"), timedelta(seconds=10), KEEP)
    got = run(found, tmp_path / "out")(spark)
    assert rows(got, "tie", "how") == [(1, "timeout"), (2, "timeout"), (3, "timeout")]


def test_new_flag_and_running_survive_a_restart(spark, session, tmp_path):
    data = [r for r in made(300, span=3000) if r[0]]
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    parts = batches(data)

    def flagged():
        return forms.correct_new_flag(feed.stream, "mid", "flag", "ts", "tie").select("tie", "flag")

    def summed():
        return forms.running(
            feed.stream, "mid", "ts", "tie", {"total": F.col("value"), "n": F.lit(1)}
        ).select("tie", "total", "n")

    for part in parts:  # each round starts the queries anew on their checkpoints
        feed.put(part)
        flags = run(flagged(), tmp_path / "flags")
        sums = run(summed(), tmp_path / "sums")
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(flags(spark)) == rows(correct_new_flag(df, "mid", "flag", "ts", "tie"), "tie", "flag")
    want = running(df, "mid", "ts", "tie", {"total": F.col("value"), "n": F.lit(1)})
    assert rows(sums(spark)) == rows(want, "tie", "total", "n")


def test_new_flag_ttl(spark, session, tmp_path):
    """With a time to live the key is forgotten, and its next new record counts again."""
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    ttl = timedelta(milliseconds=1)

    out = tmp_path / "out"

    def emitted():
        done = list((out / "data").glob("_spark_metadata/*"))
        return rows(spark.read.schema("tie BIGINT, flag STRING").parquet(str(out / "data"))) if done else []

    def wait_for(n):
        until = time.time() + 30
        while len(emitted()) < n and time.time() < until and query.exception() is None:
            time.sleep(0.2)

    feed.put([("a", at(0), 1, True, "1", 0), ("a", at(1), 2, True, "1", 0)])
    fixed = forms.correct_new_flag(feed.stream, "mid", "flag", "ts", "tie", ttl=ttl)
    query = (
        fixed.select("tie", "flag").writeStream.format("parquet").option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/state").trigger(processingTime="500 milliseconds").start()
    )
    try:
        wait_for(2)
        time.sleep(0.5)
        feed.put([("a", at(2), 3, True, "1", 0)])
        wait_for(3)
    finally:
        query.stop()
    assert emitted() == [(1, "1"), (2, "0"), (3, "1")]


def test_first_per_day_over_batches(spark, session, tmp_path):
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    day = 86_400
    feed.put([("a", at(0), 1, True, "0", 0)])
    feed.put([("a", at(60), 2, True, "0", 0), ("b", at(61), 3, True, "0", 0)])
    feed.put([("a", at(day), 4, True, "0", 0), ("a", at(day + 1), 5, False, "0", 0)])
    feed.put([("a", at(day + 5), 6, True, "0", 0)])
    found = forms.first_per_day(feed.stream, "mid", "ts", F.col("entry"))
    assert rows(run(found, tmp_path / "out")(spark), "tie") == [(1,), (3,), (4,)]


def test_count_with_timeout(spark, session, tmp_path):
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    feed.put([("a", at(0), 1, True, "0", 0), ("a", at(0.099), 2, True, "0", 0)])
    feed.put([("a", at(0.199), 3, True, "0", 0), ("b", at(0.2), 4, True, "0", 0)])
    feed.put([END])
    timed = forms.watermarked(feed.stream, "ts")
    found = forms.count_with_timeout(timed, "mid", "ts")
    # The third record comes exactly 100 ms after the second: the session has ended.
    assert rows(run(found, tmp_path / "out")(spark), "mid", "n") == [("a", 1), ("a", 2), ("b", 1)]


def test_interval_join_over_batches(spark, session, tmp_path):
    one = Feed(spark, session, tmp_path / "one", "id STRING, name STRING, t1 TIMESTAMP")
    two = Feed(spark, session, tmp_path / "two", "id2 STRING, sex STRING, t2 TIMESTAMP")
    one.put([("a", "x", at(0)), ("b", "y", at(1))])
    two.put([("a", "low", at(-5)), ("a", "in", at(-4.999))])
    one.put([("a", "late", at(8))])
    two.put([("a", "mid", at(4.999)), ("b", "no", at(6)), ("b", "yes", at(5.5))])
    five = timedelta(seconds=5)
    found = interval_join(
        forms.watermarked(one.stream, "t1", timedelta(seconds=30)),
        forms.watermarked(two.stream, "t2", timedelta(seconds=30)),
        [("id", "id2")], "t1", "t2", -five, five,
    )
    got = rows(run(found, tmp_path / "out")(spark), "name", "sex")
    assert got == [("late", "mid"), ("x", "in"), ("x", "mid"), ("y", "yes")]


def test_interval_join_state_is_bounded(spark, session, tmp_path):
    """Rows of both sides leave the state once the watermark has passed their interval."""
    one = Feed(spark, session, tmp_path / "one", "id STRING, name STRING, t1 TIMESTAMP")
    two = Feed(spark, session, tmp_path / "two", "id2 STRING, sex STRING, t2 TIMESTAMP")
    for step in range(4):
        one.put([(f"k{step}", "x", at(step * 1000))])
        two.put([(f"k{step}", "y", at(step * 1000 + 1))])
    five = timedelta(seconds=5)
    found = interval_join(
        forms.watermarked(one.stream, "t1"), forms.watermarked(two.stream, "t2"),
        [("id", "id2")], "t1", "t2", -five, five,
    )
    query = start(
        found.writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "c")), "bounded", once=True,
    )
    finish(query)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept <= 4


def test_visitor_stats_windows(spark, session, tmp_path):
    schema = "vc STRING, ch STRING, ar STRING, is_new STRING, uv_ct BIGINT, pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT, ts BIGINT"
    feed = Feed(spark, session, tmp_path / "in", schema)
    key = ("v", "c", "a", "0")
    feed.put([(*key, 1, 0, 0, 0, 0, 9_999), (*key, 0, 1, 1, 0, 30, 0), (*key, 0, 0, 0, 1, 0, 10_000)])
    feed.put([("end", "", "", "", 0, 0, 0, 0, 0, 10**12)])
    got = run(visitor_stats(feed.stream), tmp_path / "out")(spark)
    assert rows(got, "stt", "edt", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts") == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:10", 1, 1, 1, 0, 30, 0),
        ("1970-01-01 00:00:10", "1970-01-01 00:00:20", 0, 0, 0, 1, 0, 10_000),
    ]


def test_product_stats_distinct_orders(spark, session, tmp_path):
    schema = "sku_id BIGINT, order_id BIGINT, amount DOUBLE, kind STRING, ts TIMESTAMP"
    feed = Feed(spark, session, tmp_path / "in", schema)
    data = [
        (1, 100, 1.1, "order", at(0)), (1, 100, 2.2, "order", at(1)), (1, 101, 0.1, "order", at(2)),
        (1, 100, 3.3, "pay", at(3)), (1, None, None, "show", at(4)), (2, 100, 5.0, "refund", at(4)),
    ]
    feed.put(data[:3])
    feed.put(data[3:])
    feed.put([(0, None, None, "show", at(10_000))])

    def stats(df):
        order = lambda kind: F.when(F.col("kind") == kind, F.col("order_id"))
        paid = lambda kind: F.when(F.col("kind") == kind, F.col("amount")).otherwise(0)
        shaped = product_rows(
            df, "ts", display_ct=(F.col("kind") == "show").cast("long"),
            order_amount=paid("order"), payment_amount=paid("pay"), refund_amount=paid("refund"),
            order_id=order("order"), paid_order_id=order("pay"), refund_order_id=order("refund"),
        )
        return product_stats(shaped).where("sku_id > 0")

    columns = ["sku_id", "order_ct", "paid_order_ct", "refund_order_ct", "display_ct", "order_amount", "payment_amount", "refund_amount"]
    want = [(1, 2, 1, 0, 1, 3.4, 3.3, 0.0), (2, 0, 0, 1, 0, 0.0, 0.0, 5.0)]
    assert rows(stats(spark.createDataFrame(data, schema)), *columns) == want
    streamed = product_stats_unfiltered(feed.stream, stats)
    assert rows(run(streamed, tmp_path / "out")(spark).where("sku_id > 0"), *columns) == want


def product_stats_unfiltered(stream, stats):
    """The marker row must reach the watermark, so its SKU passes the filter above."""
    return stats(stream.withColumn("sku_id", F.col("sku_id") + 10)).withColumn(
        "sku_id", F.col("sku_id") - 10
    )


def test_rules_change_while_the_job_runs(spark, session, tmp_path):
    schema = "seq BIGINT, topic STRING, value STRING"
    feed = Feed(spark, session, tmp_path / "in", schema)
    rules = []

    def in_force():
        return spark.createDataFrame(
            rules,
            "sourceTable STRING, operateType STRING, sinkType STRING, sinkTable STRING, "
            "sinkColumns STRING, sinkPk STRING, sinkExtend STRING",
        )

    store = dims.DimStore(spark, str(tmp_path / "dims"))
    target = Endpoint("files", str(tmp_path / "out"))

    def go():
        writer = jobs.base_db_job(feed.stream, in_force, "seq", target, store, str(tmp_path / "state"))
        finish(start(writer, "router", once=True))

    def row(seq, key, name):
        return (seq, "s.shop.t", '{"after":{"id":"%s","name":"%s"},"op":"c"}' % (key, name))

    feed.put([row(1, "1", "one")])
    go()
    rules.append(("t", "insert", "kafka", "topic_t", "name", None, None))
    feed.put([row(2, "2", "two")])
    go()
    rules[0] = ("t", "insert", "hbase", "dim_t", "id,name", None, None)
    feed.put([row(3, "3", "three"), row(4, "3", "drei")])
    go()
    sent = spark.read.text(target.at)
    assert rows(sent, "topic", "value") == [
        ("dwd_unmatched", '{"table":"t","type":"insert","after":{"id":"1","name":"one"}}'),
        ("topic_t", '{"name":"two"}'),
    ]
    assert rows(store.read("dim_t", ["id", "name"], "id")) == [("3", "drei")]
    assert rows(cdc.latest_rules(in_force().withColumn("seq", F.lit(1)), "seq"), "sinkTable") == [("dim_t",)]


def test_base_log_job_writes_topics(spark, session, tmp_path):
    path = tmp_path / "ods" / "topic=ods_base_log"
    path.mkdir(parents=True)
    line = '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"p"},"ts":%d}'
    (path / "a.txt").write_text("\n".join([line % 2, line % 1, "broken"]) + "\n")
    source = Endpoint("files", str(tmp_path / "ods"))
    lines = text_stream(session, source, "ods_base_log").withColumn("offset", F.length("value"))
    target = Endpoint("files", str(tmp_path / "dwd"))
    finish(start(jobs.base_log_job(lines, "offset", target, str(tmp_path / "c")), "log", once=True))
    out = spark.read.text(target.at)
    flags = out.where("topic = 'dwd_page_log'").select(
        F.get_json_object("value", "$.ts").alias("ts"),
        F.get_json_object("value", "$.common.is_new").alias("f"),
    )
    assert rows(flags) == [("1", "1"), ("2", "0")]
    assert rows(out.where("topic = 'dwd_dirty_log'"), "value") == [("broken",)]


def test_enrich_job_reads_dimensions_per_batch(spark, session, sf, tmp_path):
    wide = spark.createDataFrame([], facade_wide(spark, sf).schema)
    source = tmp_path / "wide"
    facade_wide(spark, sf).write.parquet(str(source))
    stream = session.readStream.schema(wide.schema).parquet(str(source))
    calls = []

    def dimensions():
        calls.append(1)
        return facade.dimensions(spark, sf)

    target = Endpoint("files", str(tmp_path / "out"))
    writer = jobs.enrich_job(stream, dimensions, facade.AS_OF, "dwm_order_wide", target, str(tmp_path / "c"))
    finish(start(writer, "enrich", once=True))
    assert calls
    assert spark.read.text(target.at).where("topic = 'dwm_order_wide'").count() == 21


def facade_wide(spark, sf):
    from rillhouse.operators.wide import merge_order_detail, prepare_orders
    from rillhouse.plans.catalog import ORDER_BOUNDS

    return merge_order_detail(
        prepare_orders(facade.order_info(facade.table(spark, sf, "orders"))),
        prepare_orders(facade.order_detail(facade.table(spark, sf, "lineitem"))),
        **ORDER_BOUNDS,
    )


def test_counter_stream_continues_after_a_restart(spark, session, tmp_path):
    seen = []
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))

    def go(n):
        got = []

        def work(batch, _):
            got.extend(r.value for r in batch.collect())

        query = (
            for_each_batch(counter_stream(session, str(tmp_path / "t"), 10), work, str(tmp_path / "c"))
            .trigger(processingTime="0 seconds").start()
        )
        until = time.time() + 30
        while len(got) < n and time.time() < until and query.exception() is None:
            time.sleep(0.05)
        query.stop()
        assert len(got) >= n
        seen.append(got)

    go(20)
    go(20)
    first, second = seen
    assert first == list(range(len(first)))
    # The batch that was running at the stop may be repeated, nothing is skipped.
    assert second[0] <= len(first) and second == list(range(second[0], second[0] + len(second)))


def test_sinks(spark, session, tmp_path):
    feed = Feed(spark, session, tmp_path / "in", "value STRING")
    feed.put([(f"line {i}",) for i in range(10)])
    target = Endpoint("files", str(tmp_path / "topics"))
    finish(start(topic_stream(feed.stream, target, str(tmp_path / "c1"), topic="t1"), "topic", once=True))
    assert rows(spark.read.text(target.at).groupBy("topic").count()) == [("t1", 10)]
    # a second job on the same root, and the first one again from a new checkpoint
    finish(start(topic_stream(feed.stream, target, str(tmp_path / "c3"), topic="t2"), "topic2", once=True))
    finish(start(topic_stream(feed.stream, target, str(tmp_path / "c4"), topic="t1"), "topic3", once=True))
    finish(start(topic_stream(feed.stream, target, str(tmp_path / "c4"), topic="t1"), "topic4", once=True))
    assert rows(spark.read.text(target.at).groupBy("topic").count()) == [("t1", 20), ("t2", 10)]
    read = run(text_stream(session, target, "t1"), tmp_path / "read")(spark)
    assert read.count() == 20 and read.select("topic", "record_ts").distinct().count() >= 1

    finish(start(buffered_stream(feed.stream, str(tmp_path / "buf"), str(tmp_path / "c2"), 4), "buf", once=True))
    files = list((tmp_path / "buf").glob("*.json"))
    assert len(files) == 3
    assert sorted(sum(1 for _ in f.open()) for f in files) == [2, 4, 4]

    shown = start(console_stream(feed.stream), "console", once=True)
    finish(shown)
    assert shown.lastProgress["numInputRows"] == 10


def test_jobs_over_topics(spark, session, tmp_path):
    """Page lines through first visits and bounces to the visitor theme; orders to payments."""
    import json

    root = tmp_path / "topics"

    def put(topic, *records_):
        path = root / f"topic={topic}"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{len(list(path.iterdir()))}.txt").write_text("\n".join(map(json.dumps, records_)) + "\n")

    base = 1_699_999_200_000  # 2023-11-14 22:00:00

    def page(mid, second, last=None):
        fields = {"page_id": "p", "during_time": 7, **({"last_page_id": last} if last else {})}
        return {"common": {"mid": mid, "ar": "a", "ch": "c", "vc": "v", "is_new": "0"}, "page": fields, "ts": base + second * 1000}

    at_ = Endpoint("files", str(root))
    read = lambda topic: text_stream(session, at_, topic)

    def go(writer, topic):
        finish(start(writer, topic, once=True))
        return text_batch(spark, at_, topic)

    def to(name):
        return at_, str(tmp_path / f"{name}_state")

    end = page("end", 10**9, "x")
    put("dwd_page_log", page("m", 0), page("m", 3, "p"), page("m", 100), page("n", 5), end)
    uv = go(jobs.unique_visit_job(read("dwd_page_log"), *to("uv")), "dwm_unique_visit")
    uj = go(jobs.user_jump_job(read("dwd_page_log"), *to("uj")), "dwm_user_jump_detail")
    ts = F.get_json_object("value", "$.ts")
    assert rows(uv.select(ts)) == [(str(base),), (str(base + 5000),)]
    assert rows(uj.select("topic", ts)) == [("dwm_user_jump_detail", str(base + s)) for s in (5000, 100_000)]

    uv_s, uj_s = read("dwm_unique_visit"), read("dwm_user_jump_detail")
    stats = run(jobs.visitor_theme(uv_s, uj_s, read("dwd_page_log")), tmp_path / "stats")(spark)
    assert rows(stats.where("ar = 'a'"), "stt", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")[0] == (
        "2023-11-14 22:00:00", 2, 3, 2, 1, 21
    )

    put("dwd_order_info", {"id": 1, "user_id": 7, "province_id": 2, "create_time": "2020-01-01 00:00:00"})
    put("dwd_order_detail", {"id": 5, "order_id": 1, "sku_id": 9, "create_time": "2020-01-01 00:00:04"},
        {"id": 6, "order_id": 1, "sku_id": 9, "create_time": "2020-01-01 00:00:05"})
    put("dwd_payment_info", {"id": 3, "order_id": 1, "create_time": "2020-01-01 00:15:00"})
    schema = {"DIM_USER_INFO": "7 f 2000-01-01", "DIM_BASE_PROVINCE": "2 P 1 I J", "DIM_SKU_INFO": "9 N 1 2 3",
              "DIM_SPU_INFO": "2 spu", "DIM_BASE_TRADEMARK": "3 tm", "DIM_BASE_CATEGORY3": "4 miss"}
    from rillhouse.schemas import DIM_COLUMNS

    def dimensions():
        return {t: spark.createDataFrame([tuple(v.split())], DIM_COLUMNS[t]) for t, v in schema.items()}

    wide = go(
        jobs.order_wide_job(read("dwd_order_info"), read("dwd_order_detail"), dimensions, "2020-01-01", *to("wide")),
        "dwm_order_wide",
    )
    field = lambda name: F.get_json_object("value", f"$.{name}")
    names = ["detail_id", "user_age", "province_name", "sku_name", "spu_name", "tm_name", "category3_name"]
    assert rows(wide.select(*[field(n) for n in names])) == [("5", "20", "P", "N", "spu", "tm", None)]

    paid = go(
        jobs.payment_wide_job(read("dwd_payment_info"), read("dwm_order_wide"), *to("paid")),
        "dwm_payment_wide",
    )
    assert rows(paid.select(field("payment_id"), field("detail_id"), field("order_create_time"))) == [
        ("3", "5", "2020-01-01 00:00:04")
    ]
