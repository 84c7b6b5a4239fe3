"""Star-schema test tables seen as the warehouse's own records.

The tables have neither logs nor change records, so every record is derived from a table row by
expressions: ``events`` is the behaviour log, ``orders`` and ``lineitem`` the order streams,
``customer``, ``nation``, ``region``, ``part`` and ``supplier`` the dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.functions.scalar import time_text
from rillhouse.operators.shape import union_all
from rillhouse.operators.themes import product_rows

# Zone-less times of the tables are read as UTC.
AS_OF = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(df: DataFrame, *names: str) -> DataFrame:
    """Times back to zone-less ones."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc(table(spark, sf_dir, "events"))


def utc(df: DataFrame) -> DataFrame:
    """Zone-less columns of a table as instants."""
    return df.withColumns(
        {n: F.col(n).cast("timestamp") for n, t in df.dtypes if t == "timestamp_ntz"}
    )


# --- behaviour log -------------------------------------------------------------------------


def _text(col: Column) -> Column:
    return col.cast("string")


def page_records(ev: DataFrame) -> DataFrame:
    """Every event as a page record; a view is an entry page, a signup is flagged new."""
    kind = F.col("event_type")
    return ev.select(
        "event_id",
        F.col("ts").alias("event_ts"),
        F.struct(
            _text(F.col("user_id") % 5).alias("ar"),
            _text(F.col("user_id") % 3).alias("ch"),
            F.when(kind == "signup", "1").otherwise("0").alias("is_new"),
            _text(F.col("user_id")).alias("mid"),
            _text(F.col("user_id") % 2).alias("vc"),
        ).alias("common"),
        F.struct(
            kind.alias("page_id"),
            F.when(kind != "view", F.lit("home")).alias("last_page_id"),
            F.floor("value").cast("long").alias("during_time"),
        ).alias("page"),
        F.unix_millis("ts").alias("ts"),
    )


def log_lines(ev: DataFrame) -> DataFrame:
    """Every event as one raw log line, some of them damaged.

    Signups are start records, errors carry an error and no page, the others are page records
    with displays (views, clicks) or an action (purchases).
    """
    kind = F.col("event_type")
    n = F.col("event_id") % 3
    item = lambda i: F.struct(
        F.lit("query").alias("display_type"),
        _text(F.col("event_id") + i).alias("item"),
        F.lit("sku_id").alias("item_type"),
        i.cast("long").alias("order"),
        (F.col("user_id") % 4).alias("pos_id"),
    )
    displays = F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), item)).otherwise(
        F.expr("filter(array(struct('' AS display_type, '' AS item, '' AS item_type, "
               "0L AS `order`, 0L AS pos_id)), x -> false)")
    )
    rows = ev.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").alias("record_ts"),
        F.unix_millis("ts").alias("ms"),
        "value",
    )
    record = F.struct(
        F.struct(
            _text(F.col("user_id") % 5).alias("ar"),
            _text(F.col("user_id") % 3).alias("ch"),
            F.when(kind == "signup", "1").otherwise("0").alias("is_new"),
            _text(F.col("user_id")).alias("mid"),
            _text(F.col("user_id")).alias("uid"),
            _text(F.col("user_id") % 2).alias("vc"),
        ).alias("common"),
        F.when(
            kind == "signup",
            F.struct(
                F.lit("icon").alias("entry"), (F.col("event_id") % 1000).alias("loading_time")
            ),
        ).alias("start"),
        F.when(
            ~kind.isin("signup", "error"),
            F.struct(
                kind.alias("page_id"),
                F.when(kind != "view", F.lit("home")).alias("last_page_id"),
                F.floor("value").cast("long").alias("during_time"),
            ),
        ).alias("page"),
        F.when(kind.isin("view", "click"), displays).alias("displays"),
        F.when(
            kind == "purchase",
            F.array(F.struct(F.lit("buy").alias("action_id"), F.col("ms").alias("ts"))),
        ).alias("actions"),
        F.when(
            kind == "error",
            F.struct((F.col("event_id") % 7).alias("error_code"), F.lit("failed").alias("msg")),
        ).alias("err"),
        F.col("ms").alias("ts"),
    )
    good = F.to_json(record)
    line = (
        F.when(F.col("event_id") % 97 == 0, F.rtrim(good, F.lit("}")))
        .when(F.col("event_id") % 89 == 1, F.concat(good, F.lit(" x")))
        .when(F.col("event_id") % 83 == 2, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(good)
    )
    # A generator of one row: the text is made once, whatever filters come later.
    return rows.select("event_id", "record_ts", F.explode(F.array(line)).alias("value"))


# --- orders, payments, dimensions ----------------------------------------------------------


def _with_text(df: DataFrame, ts: str) -> DataFrame:
    """Add the time as ``text``, through a generator of one row so that it is made once."""
    return df.select("*", F.explode(F.array(time_text(ts))).alias("text"))


def order_info(orders: DataFrame) -> DataFrame:
    return _with_text(orders, "o_orderdate").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 30).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("text").alias("create_time"),
        F.lit(None).cast("string").alias("create_date"),
        F.lit(None).cast("string").alias("create_hour"),
        F.col("o_custkey").alias("user_id"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    return _with_text(lineitem, "l_shipdate").select(
        F.col("l_linenumber").cast("long").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        F.col("text").alias("create_time"),
        F.col("l_discount").alias("split_activity_amount"),
        F.col("l_tax").alias("split_coupon_amount"),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    """A payment for every finished order; the time text of some does not parse."""
    at = F.col("text")
    return _with_text(orders.where("o_orderstatus = 'F'"), "o_orderdate").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("subject"),
        F.col("o_orderstatus").alias("payment_type"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("unknown")).otherwise(at).alias("create_time"),
        at.alias("callback_time"),
        F.col("o_orderdate").alias("record_ts"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    key = lambda name: _text(F.col(name)).alias("ID")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
    return {
        "DIM_USER_INFO": customer.select(
            key("c_custkey"),
            F.col("c_mktsegment").alias("GENDER"),
            _text(born).alias("BIRTHDAY"),
        ),
        "DIM_BASE_PROVINCE": nation.join(
            region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
        ).select(
            key("n_nationkey"),
            F.col("n_name").alias("NAME"),
            _text(F.col("n_regionkey")).alias("AREA_CODE"),
            F.col("r_name").alias("ISO_CODE"),
            F.concat(F.col("r_name"), F.lit("-"), _text(F.col("n_nationkey"))).alias("ISO_3166_2"),
        ),
        "DIM_SKU_INFO": part.select(
            key("p_partkey"),
            F.col("p_name").alias("SKU_NAME"),
            _text(F.col("p_size") % 7).alias("CATEGORY3_ID"),
            _text(F.col("p_size")).alias("SPU_ID"),
            _text(F.col("p_partkey") % 120).alias("TM_ID"),
        ),
        "DIM_SPU_INFO": nation.select(key("n_nationkey"), F.col("n_name").alias("SPU_NAME")),
        "DIM_BASE_TRADEMARK": supplier.select(key("s_suppkey"), F.col("s_name").alias("TM_NAME")),
        "DIM_BASE_CATEGORY3": region.select(key("r_regionkey"), F.col("r_name").alias("NAME")),
    }


# --- change records ------------------------------------------------------------------------

_OPS = ["c", "u", "d", "r"]


def _cells(name: str) -> tuple[str, dict[str, Column]]:
    """Key and change-record cells of a table."""
    if name == "orders":
        return "o_orderkey", {
            "id": F.col("o_orderkey"),
            "status": F.col("o_orderstatus"),
            "priority": F.col("o_orderpriority"),
        }
    if name == "customer":
        return "c_custkey", {
            "id": F.col("c_custkey"),
            "name": F.col("c_name"),
            "segment": F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")),
        }
    return "s_suppkey", {"supplier_id": F.col("s_suppkey"), "name": F.col("s_name")}


def change_lines_of(name: str, rows: DataFrame) -> DataFrame:
    """Rows of a table as raw change records; the operation follows from the key."""
    key, cells = _cells(name)
    op = F.element_at(F.array(*[F.lit(o) for o in _OPS]), (F.col(key) % 4 + 1).cast("int"))
    image = F.map_from_arrays(
        F.array(*[F.lit(c) for c in cells]), F.array(*[_text(v) for v in cells.values()])
    )
    value = F.to_json(
        F.struct(
            F.when(op.isin("u", "d"), image).alias("before"),
            F.when(op != "d", image).alias("after"),
            op.alias("op"),
        )
    )
    # A generator of one row: the text is made once, whatever filters come later.
    return rows.select(
        F.col(key).cast("long").alias("seq"),
        F.lit(f"mysql.shop.{name}").alias("topic"),
        F.explode(F.array(value)).alias("value"),
    )


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables as one feed of raw change records."""
    names = ("orders", "customer", "supplier")
    return union_all([change_lines_of(n, table(spark, sf_dir, n)) for n in names])


# Rule changes in order: a later rule replaces an earlier one, a delete removes a rule.
RULES = [
    # seq, change type, source table, operation, sink type, sink table, sink columns, sink key
    (1, "insert", "orders", "insert", "kafka", "dwd_old", "id", None),
    (2, "insert", "orders", "insert", "kafka", "dwd_order_info", "id,status", None),
    (3, "insert", "orders", "update", "clickhouse", "olap_orders", "id,priority", ""),
    (4, "insert", "customer", "insert", "hbase", "dim_user", "id,name,segment", "id"),
    (5, "insert", "customer", "update", "hbase", "dim_user", "id,segment,missing", None),
    (6, "insert", "supplier", "insert", "hbase", "dim_supplier", "supplier_id,name", "supplier_id"),
    (7, "insert", "supplier", "update", "kafka", "dwd_supplier", "name", None),
    (8, "delete", "supplier", "update", "kafka", "dwd_supplier", "name", None),
]


def rule_changes(spark: SparkSession) -> DataFrame:
    """The rule table's change feed in the normalised envelope."""
    flat = spark.createDataFrame(
        RULES,
        "seq BIGINT, type STRING, sourceTable STRING, operateType STRING, sinkType STRING, "
        "sinkTable STRING, sinkColumns STRING, sinkPk STRING",
    )
    names = flat.columns[2:]
    image = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names])
    )
    empty = F.expr("cast(map() as map<string,string>)")
    gone = F.col("type") == "delete"
    return flat.select(
        "seq",
        F.lit("shop").alias("database"),
        F.lit("table_process").alias("table"),
        F.when(gone, image).otherwise(empty).alias("before"),
        F.when(gone, empty).otherwise(image).alias("after"),
        "type",
    )


def customer_changes(orders: DataFrame) -> DataFrame:
    """Each order changes its customer's row: some cells absent, some null."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    with_day = F.map_from_arrays(
        F.array(F.lit("status"), F.lit("last_day")),
        F.array(status, F.date_format("o_orderdate", "yyyy-MM-dd")),
    )
    with_priority = F.map_from_arrays(
        F.array(F.lit("status"), F.lit("priority")),
        F.array(F.when(status != "P", status), priority),
    )
    return orders.select(
        _text(F.col("o_custkey")).alias("id"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderkey") % 2 == 0, with_day).otherwise(with_priority).alias("after"),
    )


# --- product sources -----------------------------------------------------------------------


def product_facts(lines: DataFrame, ev: DataFrame) -> list[DataFrame]:
    """The same rows' measures with each table read once: an order line carries its own payment
    and refund, an event its one count."""
    kind = F.col("event_type")
    one = lambda name: (kind == name).cast("long")
    finished, returned = F.col("l_linestatus") == "F", F.col("l_returnflag") == "R"
    price, order = F.col("l_extendedprice"), F.col("l_orderkey")
    return [
        product_rows(
            lines.withColumn("sku_id", F.col("l_partkey")),
            "l_shipdate",
            order_sku_num=F.col("l_quantity"),
            order_amount=price,
            order_id=order,
            payment_amount=F.when(finished, price).otherwise(0),
            paid_order_id=F.when(finished, order),
            refund_amount=F.when(returned, price).otherwise(0),
            refund_order_id=F.when(returned, order),
        ),
        product_rows(
            ev.withColumn("sku_id", F.col("event_id") % 1000),
            "ts",
            display_ct=one("view"),
            click_ct=one("click"),
            favor_ct=one("signup"),
            cart_ct=one("purchase"),
            comment_ct=one("error"),
            good_comment_ct=((kind == "error") & (F.col("value") >= 50)).cast("long"),
        ),
    ]


def product_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return product_rows_of(utc(table(spark, sf_dir, "lineitem")), events(spark, sf_dir))


def product_rows_of(lines: DataFrame, ev: DataFrame) -> list[DataFrame]:
    """The inputs of the product theme in one shape.

    Order lines give orders; those with a finished line payments, returned ones refunds. Views,
    clicks, signups and errors stand for displays, clicks, favourites and comments of the SKU
    ``event_id % 1000``, purchases for cart additions.
    """
    lines = lines.withColumn("sku_id", F.col("l_partkey"))
    ev = ev.withColumn("sku_id", F.col("event_id") % 1000)
    one = F.lit(1)

    def of(kind: str, **measures: Column) -> DataFrame:
        return product_rows(ev.where(F.col("event_type") == kind), "ts", **measures)

    return [
        product_rows(
            lines,
            "l_shipdate",
            order_sku_num=F.col("l_quantity"),
            order_amount=F.col("l_extendedprice"),
            order_id=F.col("l_orderkey"),
        ),
        product_rows(
            lines.where("l_linestatus = 'F'"),
            "l_shipdate",
            payment_amount=F.col("l_extendedprice"),
            paid_order_id=F.col("l_orderkey"),
        ),
        product_rows(
            lines.where("l_returnflag = 'R'"),
            "l_shipdate",
            refund_amount=F.col("l_extendedprice"),
            refund_order_id=F.col("l_orderkey"),
        ),
        of("view", display_ct=one),
        of("click", click_ct=one),
        of("signup", favor_ct=one),
        of("purchase", cart_ct=one),
        of("error", comment_ct=one, good_comment_ct=(F.col("value") >= 50).cast("long")),
    ]
