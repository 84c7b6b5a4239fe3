from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas
from rillhouse.functions import scalar
from rillhouse.operators import shape, summaries, wide
from rillhouse.plans import ads, facade
from rillhouse.sources import readers, writers
from rillhouse.sources.readers import Endpoint
from tests.conftest import at, rows


def test_times(spark):
    df = spark.createDataFrame(
        [("2021-11-30 00:30:57",), ("2021-11-30T00:30:57",), ("2021-11-30",), ("2021-13-30 00:00:00",), ("x",), (None,)],
        "t STRING",
    )
    got = {r.t: r.ms for r in df.select("t", scalar.epoch_millis("t").alias("ms")).collect()}
    assert got.pop("2021-11-30 00:30:57") == 1638232257000
    assert set(got.values()) == {None}
    good = df.where("t = '2021-11-30 00:30:57'").withColumn("ts", scalar.parse_time("t"))
    assert rows(
        good.select(scalar.time_text("ts"), scalar.create_date("ts"), scalar.create_hour("ts"))
    ) == [("2021-11-30 00:30:57", "2021-11-30", "00")]
    assert rows(good.select(scalar.day_of_millis(F.unix_millis("ts")))) == [(date(2021, 11, 30),)]


def test_zone_is_the_sessions(spark):
    df = spark.createDataFrame([("2021-11-30 08:00:00",)], "t STRING")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert rows(df.select(scalar.epoch_millis("t"))) == [(1638230400000,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_age(spark):
    df = spark.createDataFrame([("2000-01-01",), ("2023-12-31",), ("2023-01-01",), ("bad",), ("2000",), (None,)], "b STRING")
    day = F.lit("2024-01-01").cast("date")
    assert {r.b: r.a for r in df.select("b", scalar.age("b", day).alias("a")).collect()} == {
        "2000-01-01": 24, "2023-12-31": 0, "2023-01-01": 1, "bad": None, "2000": None, None: None
    }


def test_event_time_falls_back(spark):
    df = spark.createDataFrame([("2021-11-30 00:00:00", at(0)), ("bad", at(1)), (None, at(2))], "c STRING, r TIMESTAMP")
    got = [r.t for r in df.select(scalar.event_time("c", "r").alias("t")).collect()]
    assert [t.timestamp() if t.tzinfo else t.replace(tzinfo=timezone.utc).timestamp() for t in got][1:] == [1_700_000_001, 1_700_000_002]


def test_action_codec(spark):
    df = spark.createDataFrame([(5, "login")], "userId BIGINT, action STRING")
    sent = df.select(scalar.encode_action(F.struct("userId", "action")).alias("b"))
    assert sent.schema["b"].dataType == T.BinaryType()
    assert rows(sent.select(scalar.decode_action("b").alias("a")).select("a.*")) == [(5, "login")]


def test_shapes(spark):
    text = spark.createDataFrame([("1 22 333",)], "value STRING")
    assert rows(shape.split_cast(text), "number") == [(1,), (22,), (333,)]
    main, side = shape.tag_side_output(shape.split_cast(text), "number")
    assert rows(side) == [("sideout-1",), ("sideout-22",), ("sideout-333",)] and main.count() == 3
    lines = spark.createDataFrame([("a,bob,12",)], "value STRING")
    assert rows(shape.from_csv_lines(lines, schemas.JOIN_ONE)) == [("a", "bob", 12)]
    assert shape.camel("order_detail_id") == "orderDetailId" and shape.camel("id") == "id"
    assert shape.camel_columns(spark.createDataFrame([(1,)], "sink_table_pk INT")).columns == ["sinkTablePk"]
    gaps = spark.createDataFrame([(1, None), (None, "x")], "a INT, b STRING")
    assert rows(shape.to_json_lines(gaps)) == [('{"a":1}',), ('{"b":"x"}',)]


def test_copy_fields(spark):
    df = spark.createDataFrame(
        [(1, "2", datetime(1970, 1, 2), [1])], "a INT, b STRING, d TIMESTAMP, arr ARRAY<INT>"
    ).withColumn("day", F.lit("1970-01-03").cast("date"))
    target = T.StructType().add("a", T.StringType()).add("b", T.LongType()).add("d", T.LongType()).add("day", T.LongType()).add("arr", T.StringType()).add("z", T.DoubleType())
    got = rows(shape.copy_fields(df, target))
    assert got[0][0] == "1" and got[0][1] == 2 and got[0][3] == 172_800_000 and got[0][4:] == (None, None)


def test_union_all(spark):
    a = spark.createDataFrame([(1, "x")], "n INT, s STRING")
    b = spark.createDataFrame([("y", 2)], "s STRING, n INT")
    assert rows(shape.union_all([a, b, a])) == [(1, "x"), (1, "x"), (2, "y")]


def test_grouping_sets_with_null_values(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 4)], "p STRING, q STRING, v INT")
    sums = {"s": F.col("v"), "n": F.lit(1)}
    assert {(r.gid, r.p, r.q, r.s, r.n) for r in summaries.rollup(df, ["p", "q"], sums).collect()} == {
        (0, "a", None, 1, 1), (0, "a", "x", 2, 1), (0, None, "x", 4, 1),
        (1, "a", None, 3, 2), (1, None, None, 4, 1), (3, None, None, 7, 3),
    }
    assert summaries.cube(df, ["p", "q"], sums).count() == 8
    assert {r.gid for r in summaries.totals(df, ["p", "q"], sums).collect()} == {0, 3}
    assert rows(summaries.filter_aggregate(df, F.col("v") > 1, ["q"], sums), "q", "s") == [("x", 6)]


def test_grouping_sets_expand_groups_not_rows(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("p"), F.col("id").alias("v"))
    plan = summaries.cube(df, ["p"], {"s": F.col("v")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")


def test_partition_counts(spark):
    assert summaries.per_partition_counts(spark.range(0, 100, 1, 4)).agg(F.sum("n")).first()[0] == 100


def test_ads_over_theme(spark):
    stats = spark.createDataFrame(
        [("v1", "c1", "a1", "1", 1, 2, 1, 0, 10), ("v1", "c1", "a2", "0", 1, 3, 1, 1, 20)],
        "vc STRING, ch STRING, ar STRING, is_new STRING, uv_ct INT, pv_ct INT, sv_ct INT, uj_ct INT, dur_sum INT",
    )
    assert rows(ads.visits_with_total(stats).where("gid = 3"), "pv_ct", "dur_sum") == [(5, 30)]
    assert rows(ads.visits_of_new(stats), "vc", "ch", "pv_ct") == [("v1", "c1", 2)]
    assert ads.visits_cube(stats).count() > ads.visits_by_channel_and_area(stats).count()


def test_wide_merge_precedence(spark):
    info = facade.order_info(
        spark.createDataFrame(
            [(1, 7, "F", 9.5, datetime(2020, 1, 1), "P")],
            "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING",
        )
    )
    detail = spark.createDataFrame(
        [(10, 1, 5, 2.5, 3, "name", "2020-01-01 00:00:04"), (11, 1, 5, 2.5, 3, "name", "2020-01-01 00:00:05")],
        "id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DOUBLE, sku_num BIGINT, sku_name STRING, create_time STRING",
    )
    merged = wide.merge_order_detail(wide.prepare_orders(info), wide.prepare_orders(detail))
    assert merged.columns == schemas.ORDER_WIDE.fieldNames() + ["event_ts"]
    assert rows(merged, "order_id", "detail_id", "create_time", "create_date", "create_hour", "total_amount") == [
        (1, 10, "2020-01-01 00:00:04", "2020-01-01", "00", 9.5)
    ]
    pay = spark.createDataFrame(
        [(100, 1, 7, 1.0, "bad", datetime(2020, 1, 1, 0, 14)), (101, 1, 7, 1.0, "2020-01-01 00:15:04", datetime(2020, 1, 1))],
        "id BIGINT, order_id BIGINT, user_id BIGINT, total_amount DOUBLE, create_time STRING, record_ts TIMESTAMP",
    )
    paid = wide.merge_payment_order(wide.with_fallback_time(pay, "record_ts"), merged)
    assert paid.columns == schemas.PAYMENT_WIDE.fieldNames() + ["event_ts"]
    # The second payment is exactly 15 minutes later, which is outside.
    assert rows(paid, "payment_id", "payment_create_time", "order_create_time", "total_amount", "user_id") == [
        (100, "bad", "2020-01-01 00:00:04", 9.5, 7)
    ]


def test_source_options():
    kafka = Endpoint("kafka", "h:9092", {"kafka.group.id": "g"})
    assert readers.source_options(kafka, "a", "b") == (
        "kafka",
        {"kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest",
         "maxOffsetsPerTrigger": readers.MAX_OFFSETS_PER_TRIGGER, "kafka.group.id": "g"},
    )
    assert readers.source_options(Endpoint("socket", "host:9999")) == ("socket", {"host": "host", "port": "9999"})
    assert readers.source_options(Endpoint("files", "/d/"), "a") == (
        "text", {"path": "/d/topic=a", "recursiveFileLookup": "true"}
    )
    assert readers.source_options(Endpoint("files", "/d"), "a", "b")[1]["path"] == "/d/topic={a,b}"
    with pytest.raises(ValueError):
        readers.source_options(Endpoint("tape", "x"), "a")


def test_jdbc_options():
    assert readers.jdbc_options("u", "select 1") == {"url": "u", "query": "select 1"}
    split = readers.jdbc_options("u", "select * from t", ("id", 0, 100, 8), {"fetchsize": "10"})
    assert split["dbtable"] == "(select * from t) q" and split["numPartitions"] == "8"
    assert (split["lowerBound"], split["upperBound"], split["fetchsize"]) == ("0", "100", "10")


def test_bound_columns():
    names = schemas.VISITOR_STATS.fieldNames()
    assert writers.bound_columns(names) == names
    assert "dur_sum" not in writers.bound_columns(names, ["dur_sum"])
    with pytest.raises(ValueError):
        writers.bound_columns(names, ["nope"])


def test_snapshot_becomes_read_changes(spark):
    from rillhouse.operators.cdc import normalize_cdc

    table = spark.createDataFrame([(1, "x"), (2, None)], "id INT, name STRING")
    changes = normalize_cdc(readers.snapshot_changes(table, "srv", "shop", "t"))
    got = {r.after["id"]: (r.database, r.table, r.type, r.after.get("name")) for r in changes.collect()}
    assert got == {"1": ("shop", "t", "read", "x"), "2": ("shop", "t", "read", None)}


def test_order_table(spark):
    lines = spark.createDataFrame(
        [('{"transactionId":"t1","orderTime":"2021-11-30T00:00:00Z","orderItems":null}',),
         ('{"transactionId":"t2","orderItems":{"orderItemId":"i","price":1.5,"itemLinkIds":{"linkId":"l","price":2}}}',)],
        "value STRING",
    )
    readers.register_order_table(lines)
    got = spark.sql("SELECT transactionId, orderTime IS NULL AS n, promiseTime FROM order_table")
    assert rows(got) == [("t1", False, None), ("t2", True, None)]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "n INT, s STRING").repartition(2)
    writers.write_csv(df, str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    assert rows(spark.read.schema(df.schema).option("sep", "|").csv(str(tmp_path / "csv"))) == [(1, "a|b"), (2, None)]
    routed = spark.createDataFrame([("t1", {"a": "1"}), (None, {"b": "2"})], "sink_table STRING, after MAP<STRING,STRING>")
    at = Endpoint("files", str(tmp_path / "t"))
    for run, batch in (("r1", 3), ("r1", 3), ("r2", 3)):  # a repeat, and another job
        writers.write_batch_topics(writers.routed_messages(routed), at, batch, run)
    back = spark.read.text(str(tmp_path / "t"))
    want = [("r1", 3, "default", '{"b":"2"}'), ("r1", 3, "t1", '{"a":"1"}')]
    assert rows(back, "run", "batch", "topic", "value") == sorted(want + [("r2", *w[1:]) for w in want])
    got = readers.text_batch(spark, at, "t1", "default")
    assert rows(got, "topic", "value") == [("default", '{"b":"2"}')] * 2 + [("t1", '{"a":"1"}')] * 2
    assert got.where("record_ts IS NULL OR offset IS NULL").isEmpty()
    cut_off = tmp_path / "t" / "_done" / "run=r1" / "batch=3"
    cut_off.unlink()
    writers.write_batch_topics(writers.routed_messages(routed), at, 3, "r1")
    assert readers.text_batch(spark, at, "t1").count() == 2


def test_messages(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert rows(writers.messages(df, "t")) == [("t", '{"a":1}')]


def test_width_text():
    from rillhouse.operators.themes import span_text

    assert span_text(timedelta(seconds=10)) == "10000000 microseconds"
