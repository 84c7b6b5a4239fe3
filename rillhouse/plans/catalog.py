"""Batch queries over the test tables, one per operator or composition."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas
from rillhouse.functions import scalar
from rillhouse.operators import cdc, dims, joins, logs, ordered, shape, summaries
from rillhouse.plans import ads, dwd, dwm, dws, facade, ods
from rillhouse.operators.wide import merge_order_detail, prepare_orders, product_dimension
from rillhouse.session import scratch
from rillhouse.sources import loads, readers, writers
from rillhouse.streaming.forms import count_with_timeout

# The test data has day- and minute-scale gaps, so the queries use wider bounds than the defaults.
ORDER_BOUNDS = {"lower": timedelta(days=-5), "upper": timedelta(days=5)}
JUMP_HORIZON = timedelta(minutes=30)
SESSION_GAP = timedelta(hours=6)
DAY = timedelta(days=1)
MONTH = timedelta(days=30)


# --- joins ---------------------------------------------------------------------------------


def interval_join_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = facade.utc(facade.table(spark, sf, "orders")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    lines = facade.utc(facade.table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    pairs = joins.interval_join(
        orders,
        lines,
        [("o_orderkey", "l_orderkey")],
        "o_orderdate",
        "l_shipdate",
        **ORDER_BOUNDS,
    )
    return facade.ntz(pairs, "o_orderdate", "l_shipdate")


def interval_join_payment(spark: SparkSession, sf: str) -> DataFrame:
    ev = facade.events(spark, sf)
    pay = ev.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"),
        F.col("user_id").alias("buyer"),
        F.col("ts").alias("purchase_ts"),
    )
    click = ev.where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts")
    )
    pairs = joins.interval_join(
        pay,
        click,
        [("buyer", "user_id")],
        "purchase_ts",
        "click_ts",
        timedelta(minutes=-15),
        timedelta(seconds=100),
    )
    return facade.ntz(pairs.drop("buyer"), "purchase_ts", "click_ts")


def interval_join_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    orders = facade.utc(facade.table(spark, sf, "orders")).select("o_orderkey", "o_orderdate")
    lines = facade.utc(facade.table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"
    )
    pairs = joins.interval_join(
        orders,
        lines,
        [("o_orderkey", "l_orderkey")],
        "o_orderdate",
        "l_shipdate",
        lower_exclusive=False,
        upper_exclusive=False,
        **ORDER_BOUNDS,
    )
    return facade.ntz(pairs, "o_orderdate", "l_shipdate")


def _order_wide(spark: SparkSession, sf: str) -> DataFrame:
    return dwm.order_wide(
        facade.order_info(facade.table(spark, sf, "orders")),
        facade.order_detail(facade.table(spark, sf, "lineitem")),
        facade.dimensions(spark, sf),
        facade.AS_OF,
        **ORDER_BOUNDS,
    )


def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _order_wide(spark, sf).drop("event_ts")


def payment_wide(spark: SparkSession, sf: str) -> DataFrame:
    payments = facade.payment_info(facade.utc(facade.table(spark, sf, "orders")))
    # A wide record read back from its topic has the time its text says, the detail's.
    wide = _order_wide(spark, sf).withColumn("event_ts", scalar.parse_time("create_time"))
    return dwm.payment_wide(payments, wide, **ORDER_BOUNDS).drop("event_ts")


def order_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The merge alone: shared names come from the detail."""
    merged = merge_order_detail(
        prepare_orders(facade.order_info(facade.table(spark, sf, "orders"))),
        prepare_orders(facade.order_detail(facade.table(spark, sf, "lineitem"))),
        **ORDER_BOUNDS,
    )
    return merged.select(
        "order_id", "detail_id", "sku_id", "create_time", "create_date", "create_hour",
        "total_amount", "order_price",
    )


def lookup_miss(spark: SparkSession, sf: str) -> DataFrame:
    docs = facade.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    marks = facade.table(spark, sf, "labels")
    return joins.lookup_enrich(
        docs, marks, "doc_id", "doc_id", {"quality": "quality", "toxic": "toxic"}
    )


def lookup_user(spark: SparkSession, sf: str) -> DataFrame:
    fact = facade.order_info(facade.table(spark, sf, "orders")).select("id", "user_id")
    day = F.lit(facade.AS_OF).cast("date")
    return joins.lookup_enrich(
        fact,
        facade.dimensions(spark, sf)["DIM_USER_INFO"],
        "user_id",
        "ID",
        {"user_gender": "GENDER", "user_age": scalar.age("BIRTHDAY", day)},
    )


def lookup_province(spark: SparkSession, sf: str) -> DataFrame:
    fact = facade.order_info(facade.table(spark, sf, "orders")).select("id", "province_id")
    return joins.lookup_enrich(
        fact,
        facade.dimensions(spark, sf)["DIM_BASE_PROVINCE"],
        "province_id",
        "ID",
        {"name": "NAME", "area_code": "AREA_CODE", "iso_code": "ISO_CODE", "iso2": "ISO_3166_2"},
    )


def lookup_product(spark: SparkSession, sf: str) -> DataFrame:
    """The SKU dimension and the three looked up through it."""
    fact = facade.order_detail(facade.table(spark, sf, "lineitem")).select(
        "order_id", "id", "sku_id"
    )
    return joins.lookup_enrich(
        fact,
        product_dimension(facade.dimensions(spark, sf)),
        "sku_id",
        "ID",
        {
            "sku_name": "SKU_NAME",
            "spu_id": F.col("SPU_ID").cast("long"),
            "spu_name": "SPU_NAME",
            "tm_id": F.col("TM_ID").cast("long"),
            "tm_name": "TM_NAME",
            "category3_id": F.col("CATEGORY3_ID").cast("long"),
            "category3_name": "CATEGORY3_NAME",
        },
    )


# --- behaviour log -------------------------------------------------------------------------


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return facade.log_lines(facade.events(spark, sf))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return logs.parse_log(_lines(spark, sf))


def log_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return logs.dirty_records(logs.parse_all(_lines(spark, sf))).select("event_id")


def log_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    messages = logs.route_log(logs.parse_all(_lines(spark, sf)))
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def log_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = logs.page_log(_parsed(spark, sf))
    return pages.select(
        "event_id",
        F.col("common.mid").alias("mid"),
        F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"),
        F.to_date(F.timestamp_millis("ts")).cast("string").alias("day"),
        "ts",
    )


def log_starts(spark: SparkSession, sf: str) -> DataFrame:
    starts = logs.start_log(_parsed(spark, sf))
    return starts.select("event_id", "start.entry", "start.loading_time", "common.is_new")


def display_explode(spark: SparkSession, sf: str) -> DataFrame:
    return logs.display_log(_parsed(spark, sf), ("event_id",))


def action_explode(spark: SparkSession, sf: str) -> DataFrame:
    return logs.action_log(_parsed(spark, sf), ("event_id",))


def error_records(spark: SparkSession, sf: str) -> DataFrame:
    errors = logs.error_log(_parsed(spark, sf))
    return errors.select("event_id", "err.error_code", "err.msg")


def base_log_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The whole detail job on raw lines: messages per topic, new flags corrected."""
    parsed = dwd.parse_stage(spark, _lines(spark, sf), scratch(spark, "parsed"))
    messages = dwd.base_log(parsed, "event_id")
    return topic_summary(messages)


def topic_summary(messages: DataFrame) -> DataFrame:
    """Messages per topic, and how many of them say the visitor is new."""
    text = F.when(F.col("topic") != logs.TOPIC_DIRTY, F.col("value"))
    flag = F.get_json_object(text, "$.common.is_new")
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.coalesce(flag, F.lit("")) == "1").cast("long")).alias("new_ct"),
    )


def entry_predicate(spark: SparkSession, sf: str) -> DataFrame:
    pages = facade.page_records(facade.events(spark, sf))
    return pages.select("event_id", logs.is_entry().alias("is_entry"))


def dirty_rate(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("record_ts").cast("string").alias("day")
    return logs.dirty_rate(logs.mark_dirty(_lines(spark, sf)), day)


# --- ordered per key -----------------------------------------------------------------------


def new_visitor_fix(spark: SparkSession, sf: str) -> DataFrame:
    flat = facade.page_records(facade.events(spark, sf)).select(
        "event_id", "event_ts", F.col("common.mid").alias("mid"),
        F.col("common.is_new").alias("is_new"),
    )
    fixed = ordered.correct_new_flag(flat, "mid", "is_new", "event_ts", "event_id")
    return facade.ntz(fixed, "event_ts")


def unique_visit(spark: SparkSession, sf: str) -> DataFrame:
    first = dwm.unique_visit(facade.page_records(facade.events(spark, sf)), "event_id")
    return first.select("event_id", "mid", F.col("day").cast("string").alias("day"), "ts")


def user_jump(spark: SparkSession, sf: str) -> DataFrame:
    jumps = dwm.user_jump(
        facade.page_records(facade.events(spark, sf)), "event_id", JUMP_HORIZON
    )
    return jumps.select("event_id", "mid", "ts", "how")


def session_count(spark: SparkSession, sf: str) -> DataFrame:
    found = ordered.sessions(facade.events(spark, sf), ["user_id"], "ts", SESSION_GAP)
    return facade.ntz(found, "session_start", "session_end")


def session_window_count(spark: SparkSession, sf: str) -> DataFrame:
    """The same sessions by the built-in session window, the form used on streams."""
    found = count_with_timeout(facade.events(spark, sf), "user_id", "ts", SESSION_GAP)
    return facade.ntz(found, "session_start", "session_end")


def running_total(spark: SparkSession, sf: str) -> DataFrame:
    rows = facade.events(spark, sf).select("event_id", "user_id", "ts", "props")
    total = ordered.running(
        rows, "user_id", "ts", "event_id", {"total": scalar.text_length("props")}
    )
    return total.select("event_id", "user_id", "total")


def running_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = facade.events(spark, sf).select("event_id", "user_id", "ts")
    counted = ordered.running(rows, "user_id", "ts", "event_id", {"n": F.lit(1)})
    return counted.select("event_id", "user_id", "n")


def key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.running_key_count(facade.table(spark, sf, "events"), "user_id")


def partition_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records per partition after a deal by line number: each number is whole in one partition."""
    dealt = facade.table(spark, sf, "lineitem").select("l_linenumber").repartition(
        5, "l_linenumber"
    )
    parts = summaries.per_partition_counts(dealt, "l_linenumber")
    return parts.groupBy("l_linenumber").agg(
        F.count_distinct("part").alias("parts"), F.sum("n").alias("n")
    )


# --- themes --------------------------------------------------------------------------------


def _visitor(spark: SparkSession, sf: str, width: timedelta) -> DataFrame:
    pages = facade.page_records(facade.events(spark, sf))
    return dws.visitor(
        dwm.unique_visit(pages, "event_id"),
        dwm.user_jump(pages, "event_id", JUMP_HORIZON),
        pages,
        width,
    )


def visitor_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _visitor(spark, sf, DAY)


def visitor_stats_10s(spark: SparkSession, sf: str) -> DataFrame:
    return _visitor(spark, sf, dws.WINDOW)


def _product(spark: SparkSession, sf: str) -> DataFrame:
    facts = facade.product_facts(
        facade.utc(facade.table(spark, sf, "lineitem")), facade.events(spark, sf)
    )
    return dws.product(facts, MONTH)


def product_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _product(spark, sf)


def product_stats_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The same theme from one input per kind of record."""
    return dws.product(facade.product_sources(spark, sf), MONTH)


def product_stats_named(spark: SparkSession, sf: str) -> DataFrame:
    products = product_dimension(facade.dimensions(spark, sf))
    named = dws.describe_products(_product(spark, sf), products)
    return named.select(
        "stt", "edt", "sku_id", "sku_name", "spu_id", "spu_name", "tm_id", "tm_name",
        "category3_id", "category3_name", "order_ct", "order_amount",
    )


def product_union(spark: SparkSession, sf: str) -> DataFrame:
    """All product sources in one shape, counted and summed per SKU."""
    rows = shape.union_all(facade.product_sources(spark, sf))
    return rows.groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("order_sku_num").alias("order_sku_num"),
        F.sum("order_amount").cast("double").alias("order_amount"),
        F.sum("click_ct").alias("click_ct"),
    )


# --- change capture ------------------------------------------------------------------------


def cdc_normalize(spark: SparkSession, sf: str) -> DataFrame:
    kept = cdc.drop_deletes(cdc.normalize_cdc(facade.change_lines(spark, sf)))
    return kept.select(
        "seq",
        "database",
        "table",
        "type",
        F.col("after")["id"].alias("id"),
        F.col("after")["name"].alias("name"),
        F.col("after")["segment"].alias("segment"),
        F.size("before").cast("long").alias("before_cells"),
        F.size("after").cast("long").alias("after_cells"),
    )


def cdc_lines_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes written as lines and read back, counted per table and type."""
    lines = ods.base_db_lines(facade.change_lines(spark, sf))
    return ods.read_base_db(lines).groupBy("table", "type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("after")).alias("cells")
    )


def route_by_rules(spark: SparkSession, sf: str) -> DataFrame:
    routed = dwd.base_db(facade.change_lines(spark, sf), facade.rule_changes(spark))
    return routed.select(
        "seq", "table", "type", "sink_type", "sink_table", "rowkey", "key_value",
        F.array_join(F.array_sort(F.map_keys("after")), ",").alias("cells"),
    )


def dim_upsert(spark: SparkSession, sf: str) -> DataFrame:
    changes = facade.customer_changes(facade.table(spark, sf, "orders"))
    columns = ["status", "priority", "last_day"]
    newest = dims.upsert_cells(changes, "id", "after", columns, "seq")
    return dims.cells_only(newest, columns).withColumnRenamed("__k", "id")


def dim_store(spark: SparkSession, sf: str) -> DataFrame:
    """The same table through the store: batches out of order and repeated, a rule that shrinks
    before a compaction and grows again, and a second run that counts from 0 again."""
    changes = facade.customer_changes(facade.table(spark, sf, "orders"))
    columns = ["status", "priority", "last_day"]
    store = dims.DimStore(spark, scratch(spark, "dims"))
    for run, batch, part, rule in (
        ("a", 2, 2, columns), ("a", 0, 0, columns), ("a", 0, 0, columns),
        ("a", 3, 3, columns), ("b", 0, 1, columns),
    ):
        rows = changes.where(F.col("seq") % 4 == part)
        store.upsert("dim_customer", batch, rows, "id", "after", rule, "seq", run)
        if batch == 3:
            shrunk = changes.where("seq % 4 = 3")
            store.upsert("dim_customer", 4, shrunk, "id", "after", ["status"], "seq", run)
            store.compact()
    return store.read("dim_customer", columns, "id")


def load_new_and_changed(spark: SparkSession, sf: str) -> DataFrame:
    orders = facade.utc(facade.table(spark, sf, "orders")).select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    )
    old = orders.where("status <> 'F'")
    return loads.new_and_changed(old, orders.where("status = 'F'"), "id", "seq")


def load_incremental(spark: SparkSession, sf: str) -> DataFrame:
    ev = facade.table(spark, sf, "events").select("event_id", "ts", "event_type")
    loaded = ev.where("event_type = 'signup'")
    return loads.incremental(ev, loaded, "ts")


# --- application layer ---------------------------------------------------------------------


def _sums() -> dict:
    return {
        "n": F.lit(1),
        "amount": scalar.money("l_extendedprice"),
        "quantity": scalar.money("l_quantity"),
    }


def _doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("amount", "quantity")}).withColumns(
        {c: F.col(c).cast("long") for c in ("gid",) if c in df.columns}
    )


def ads_rollup(spark: SparkSession, sf: str) -> DataFrame:
    lines = facade.table(spark, sf, "lineitem")
    return _doubles(summaries.rollup(lines, ["l_returnflag", "l_linestatus"], _sums()))


def ads_cube(spark: SparkSession, sf: str) -> DataFrame:
    lines = facade.table(spark, sf, "lineitem")
    dims3 = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return _doubles(summaries.cube(lines, dims3, _sums()))


def ads_totals(spark: SparkSession, sf: str) -> DataFrame:
    lines = facade.table(spark, sf, "lineitem")
    return _doubles(summaries.totals(lines, ["l_returnflag", "l_linestatus"], _sums()))


def ads_filter_agg(spark: SparkSession, sf: str) -> DataFrame:
    lines = facade.table(spark, sf, "lineitem")
    return _doubles(
        summaries.filter_aggregate(
            lines, F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"),
            ["l_returnflag"], _sums(),
        )
    )


def ads_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Rollup over the visitor theme, as displayed."""
    rolled = ads.visits_by_channel_and_area(_visitor(spark, sf, DAY))
    return rolled.withColumn("gid", F.col("gid").cast("long"))


# --- small operators -----------------------------------------------------------------------


def split_cast(spark: SparkSession, sf: str) -> DataFrame:
    lines = facade.table(spark, sf, "events").select(
        F.concat_ws(" ", "user_id", "event_id").alias("value")
    )
    return shape.split_cast(lines)


def side_output(spark: SparkSession, sf: str) -> DataFrame:
    main, side = shape.tag_side_output(facade.table(spark, sf, "events"), "event_id")
    return main.select(F.col("event_id").cast("string").alias("event_id")).unionByName(side)


def csv_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = facade.events(spark, sf).select(
        F.concat_ws(",", "user_id", "event_type", F.unix_seconds("ts")).alias("value")
    )
    return shape.from_csv_lines(lines, schemas.JOIN_ONE)


def text_time(spark: SparkSession, sf: str) -> DataFrame:
    orders = facade.utc(facade.table(spark, sf, "orders")).select(
        "o_orderkey", scalar.time_text("o_orderdate").alias("text")
    )
    at = scalar.parse_time("text")
    return orders.select(
        "o_orderkey",
        "text",
        scalar.epoch_millis("text").alias("ms"),
        scalar.create_date(at).alias("create_date"),
        scalar.create_hour(at).alias("create_hour"),
        scalar.day_of_millis(scalar.epoch_millis("text")).cast("string").alias("day"),
        scalar.text_length("text").cast("long").alias("length"),
        scalar.age(F.col("text").substr(1, 10), F.lit("2024-01-01").cast("date")).alias("age"),
    )


def event_time_fallback(spark: SparkSession, sf: str) -> DataFrame:
    payments = facade.payment_info(facade.utc(facade.table(spark, sf, "orders")))
    timed = payments.select(
        "id", scalar.event_time("create_time", F.col("record_ts") + F.expr("INTERVAL 1 HOUR"))
        .alias("event_ts"),
    )
    return facade.ntz(timed, "event_ts")


def action_codec(spark: SparkSession, sf: str) -> DataFrame:
    ev = facade.table(spark, sf, "events")
    sent = ev.select(
        "event_id",
        scalar.encode_action(
            F.struct(F.col("user_id").alias("userId"), F.col("event_type").alias("action"))
        ).alias("bytes"),
    )
    return sent.select("event_id", scalar.decode_action("bytes").alias("a")).select(
        "event_id", F.col("a.userId").alias("user_id"), F.col("a.action").alias("action")
    )


def copy_fields(spark: SparkSession, sf: str) -> DataFrame:
    target = (
        T.StructType()
        .add("o_orderkey", T.StringType())
        .add("o_totalprice", T.DoubleType())
        .add("o_orderdate", T.LongType())
        .add("absent", T.StringType())
    )
    return shape.copy_fields(facade.utc(facade.table(spark, sf, "orders")), target)


def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    ev = facade.table(spark, sf, "events")
    rows = ev.select(
        "event_id",
        "event_type",
        F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("buyer"),
    )
    return shape.to_json_lines(rows)


def camel_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = facade.table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "order_key_id"})
    return shape.camel_columns(orders)


def counter(spark: SparkSession, sf: str) -> DataFrame:
    """The customers, numbered from 0 by key."""
    return readers.counter(facade.table(spark, sf, "customer").select("c_custkey"), "c_custkey")


def order_table(spark: SparkSession, sf: str) -> DataFrame:
    """JSON orders as a named table; the column the JSON lacks is null."""
    orders = facade.utc(facade.table(spark, sf, "orders"))
    lines = orders.select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").cast("string").alias("transactionId"),
                F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("orderTime"),
            )
        ).alias("value")
    )
    return facade.ntz(readers.order_table(lines), "orderTime", "promiseTime")


def ads_visits_cube(spark: SparkSession, sf: str) -> DataFrame:
    return ads.visits_cube(_visitor(spark, sf, DAY)).withColumn("gid", F.col("gid").cast("long"))


def ads_visits_total(spark: SparkSession, sf: str) -> DataFrame:
    found = ads.visits_with_total(_visitor(spark, sf, DAY))
    return found.withColumn("gid", F.col("gid").cast("long"))


def ads_visits_new(spark: SparkSession, sf: str) -> DataFrame:
    return ads.visits_of_new(_visitor(spark, sf, DAY))


def snapshot_records(spark: SparkSession, sf: str) -> DataFrame:
    """A table's rows as change records of the kind "read", normalised."""
    rows = facade.table(spark, sf, "customer")
    changes = readers.snapshot_changes(rows, "srv", "shop", "customer")
    return cdc.normalize_cdc(changes).select(
        "database", "table", "type",
        F.col("after")["c_custkey"].alias("id"), F.col("after")["c_name"].alias("name"),
        F.size("before").alias("before_cells"),
    )


def csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written as pipe-delimited text and read back."""
    parts = facade.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    path = scratch(spark, "csv")
    writers.write_csv(parts, path)
    return spark.read.schema(parts.schema).option("sep", "|").csv(path)


def routed_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Messages written to one folder per topic and read back, counted."""
    messages = logs.route_log(logs.parse_all(_lines(spark, sf)))
    path = scratch(spark, "topics")
    writers.write_topics(messages, path)
    back = spark.read.schema("value STRING, topic STRING").text(path)
    return back.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _messages(spark: SparkSession, sf: str, topic: str) -> DataFrame:
    """Messages of one topic, from log lines with fields that no schema names."""
    ev = facade.events(spark, sf)
    line = F.format_string(
        '{"event_id":%d,"common":{"ext":{"q":%d},"is_new":"%s","mid":"%d"},"displays":['
        '{"item":"%d","from":{"page_id":"inner"},"page_id":"old"},{"note":[{"b":1},null]}],'
        '"page":{"page_id":"%s"},"sid":"s{%d}","ts":%d}',
        "event_id", F.col("user_id") % 7, F.when(F.col("event_type") == "signup", "1").otherwise("0"),
        "user_id", "event_id", "event_type", "event_id", F.unix_millis("ts"),
    )
    logs_ = logs.parse_all(ev.select("event_id", F.col("ts").alias("event_ts"), line.alias("value")))
    flat = logs_.select("*", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))
    fixed = ordered.correct_new_flag(flat, "mid", "is_new", "event_ts", "event_id").withColumn(
        "common", F.col("common").withField("is_new", F.col("is_new"))
    )
    return logs.route_log(fixed).where(F.col("topic") == topic)


def log_messages_page(spark: SparkSession, sf: str) -> DataFrame:
    """Whole page messages: nothing is lost, and flags are corrected in place."""
    found = _messages(spark, sf, logs.TOPIC_PAGE)
    event = F.get_json_object("value", "$.event_id").cast("long")
    return found.select(event.alias("event_id"), "value")


def log_messages_display(spark: SparkSession, sf: str) -> DataFrame:
    """Whole display messages of the first display of each page."""
    found = _messages(spark, sf, logs.TOPIC_DISPLAY)
    item = F.get_json_object("value", "$.item").cast("long")
    return found.select(item.alias("event_id"), "value").where("event_id is not null")


def unreadable_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change records, a seventh of which are cut off; their texts are kept."""
    lines = facade.change_lines_of("customer", facade.table(spark, sf, "customer"))
    cut = F.concat(F.lit("cut "), F.col("seq"), F.lit(" {"))
    broken = lines.withColumn("value", F.when(F.col("seq") % 7 == 0, cut).otherwise(F.col("value")))
    return cdc.normalize_cdc(broken, unreadable="text").select("seq", "table", "type", "text")


QUERIES = {
    log_messages_page.__name__: log_messages_page,
    log_messages_display.__name__: log_messages_display,
    unreadable_changes.__name__: unreadable_changes,
} | {
    f.__name__: f
    for f in (
        interval_join_orders, interval_join_payment, interval_join_inclusive, order_merge,
        order_wide, payment_wide, lookup_user, lookup_province, lookup_product, lookup_miss,
        log_dirty, log_split_counts, log_pages, log_starts, display_explode, action_explode,
        error_records, base_log_messages, entry_predicate, dirty_rate, new_visitor_fix,
        unique_visit, user_jump, session_count, session_window_count, running_total,
        running_count, key_counts, partition_counts, visitor_stats, visitor_stats_10s,
        product_stats, product_stats_sources, product_stats_named, product_union,
        cdc_normalize, cdc_lines_roundtrip,
        route_by_rules, dim_upsert, dim_store, load_new_and_changed, load_incremental,
        ads_visits_cube, ads_visits_total, ads_visits_new, snapshot_records,
        ads_rollup, ads_cube, ads_totals, ads_filter_agg, ads_visits, split_cast, side_output,
        csv_parse, text_time, event_time_fallback, action_codec, copy_fields, json_lines,
        camel_columns, counter, order_table, csv_sink, routed_sink,
    )
}
