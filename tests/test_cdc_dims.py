import json

import pytest
from pyspark.sql import functions as F

from rillhouse.operators import cdc, dims
from rillhouse.plans import facade, ods
from rillhouse.sources import loads
from tests.conftest import rows


def change(op, before=None, after=None):
    return json.dumps({"before": before, "after": after, "op": op})


@pytest.fixture(scope="module")
def raw(spark):
    data = [
        (1, "srv.shop.orders", change("c", None, {"id": "1", "a": "x", "b": None})),
        (2, "srv.shop.orders", change("u", {"id": "1"}, {"id": "1", "a": "y"})),
        (3, "srv.shop.orders", change("d", {"id": "1"}, None)),
        (4, "srv.shop.orders", change("r", None, {"id": "2", "a": "z", "extra": "e"})),
        (5, "srv.shop.other", change("CREATE", None, {"id": "9"})),
        (6, "srv.shop.orders", change(None, None, {"id": "3"})),
    ]
    return spark.createDataFrame(data, "seq BIGINT, topic STRING, value STRING")


def test_normalise(raw):
    out = cdc.normalize_cdc(raw)
    assert rows(out, "seq", "database", "table", "type") == [
        (1, "shop", "orders", "insert"), (2, "shop", "orders", "update"),
        (3, "shop", "orders", "delete"), (4, "shop", "orders", "read"),
        (5, "shop", "other", "insert"), (6, "shop", "orders", None),
    ]
    sizes = {r.seq: (r.b, r.a) for r in out.select("seq", F.size("before").alias("b"), F.size("after").alias("a")).collect()}
    assert sizes[1] == (0, 3) and sizes[3] == (1, 0)
    assert rows(cdc.drop_deletes(out), "seq") == [(1,), (2,), (4,), (5,), (6,)]


def test_lines_round_trip(raw):
    back = ods.read_base_db(ods.base_db_lines(raw))
    want = cdc.normalize_cdc(raw).drop("seq")
    text = [F.to_json(F.struct("database", "table", "before", "after", "type"))]
    assert rows(back.select(*text)) == rows(want.select(*text))


def test_rules_last_wins_and_delete_removes(spark):
    rules = cdc.current_rules(facade.rule_changes(spark), "seq")
    got = {(r.sourceTable, r.operateType): r.sinkTable for r in rules.collect()}
    assert got[("orders", "insert")] == "dwd_order_info"
    assert ("supplier", "update") not in got
    assert len(got) == 5


def rule_table(spark, *data):
    return spark.createDataFrame(
        list(data),
        "sourceTable STRING, operateType STRING, sinkType STRING, sinkTable STRING, "
        "sinkColumns STRING, sinkPk STRING, sinkExtend STRING",
    )


def test_routing(spark, raw):
    rules = rule_table(
        spark,
        ("orders", "insert", "hbase", "dim_o", "id,a, b,missing", " ", None),
        ("orders", "update", "clickhouse", "olap_o", "a", "a", None),
    )
    normal = cdc.drop_deletes(cdc.normalize_cdc(raw))
    routed = cdc.route_by_rules(normal, rules)
    got = {r.seq: r for r in routed.collect()}
    # Column names are compared as they stand: " b" is not "b".
    assert got[1].after == {"id": "1", "a": "x"} and got[1].rowkey == "id" and got[1].key_value == "1"
    assert got[2].sink_type == "clickhouse" and got[2].after == {"a": "y"} and got[2].key_value == "y"
    assert got[4].sink_table == "dim_o" and got[4].type == "read"
    assert got[5].sink_type == "unmatched" and got[5].after == {"id": "9"}
    assert got[6].sink_type == "unmatched"
    split = cdc.split_routes(routed)
    assert {k: v.count() for k, v in split.items()} == {"kafka": 0, "hbase": 2, "clickhouse": 1, "unmatched": 2}
    strict = cdc.route_by_rules(normal, rules, snapshot_as_insert=False)
    assert rows(strict.where("seq = 4"), "sink_type") == [("unmatched",)]
    # The same without a broadcast.
    assert rows(cdc.route_by_rules(normal, rules, max_bytes=40), "seq", "sink_type") == rows(routed, "seq", "sink_type")


def test_sink_schema():
    schema = cdc.sink_schema("name,id", None)
    assert schema.simpleString() == "struct<name:string,id:string>"
    assert [f.nullable for f in schema.fields] == [True, False]
    assert cdc.sink_schema("name", "code").fieldNames() == ["code", "name"]


def cells(spark, data):
    return spark.createDataFrame(data, "id STRING, seq BIGINT, after MAP<STRING,STRING>")


UPDATES = [
    ("1", 1, {"a": "a1", "b": "b1"}),
    ("1", 3, {"a": "a3"}),  # fewer columns: b stays
    ("1", 2, {"a": "a2", "b": "b2"}),  # out of order
    ("1", 4, {"b": None}),  # a null cell leaves the old value
    ("2", 1, {"c": "c1"}),
    (None, 9, {"a": "lost"}),
]
NEWEST = [("1", "a3", "b2", None), ("2", None, None, "c1")]


def test_cellwise_upsert(spark):
    out = dims.upsert_cells(cells(spark, UPDATES), "id", "after", ["a", "b", "c"], "seq")
    assert rows(dims.cells_only(out, ["a", "b", "c"])) == NEWEST
    flat = cells(spark, UPDATES).select("id", "seq", F.col("after")["a"].alias("a"), F.col("after")["b"].alias("b"))
    assert rows(dims.upsert_columns(flat, "id", ["a", "b"], "seq")) == [("1", "a3", "b2"), ("2", None, None)]


def test_store_is_independent_of_order_repeats_and_compaction(spark, tmp_path):
    store = dims.DimStore(spark, str(tmp_path))
    columns = ["a", "b", "c"]
    store.create_if_absent("d", columns)
    assert store.read("d", columns, "id").count() == 0
    for batch, part in ((0, UPDATES[3:]), (1, UPDATES[1:3]), (2, UPDATES[:1]), (1, UPDATES[1:3])):
        store.upsert("d", batch, cells(spark, part), "id", "after", columns, "seq")
    assert rows(store.read("d", columns, "id")) == NEWEST
    store.compact()
    assert rows(store.read("d", columns, "id")) == NEWEST
    store.upsert("d", 3, cells(spark, [("2", 5, {"c": "c5", "d": "d5"})]), "id", "after", columns + ["d"], "seq")
    got = rows(store.read("d", columns + ["d"], "id"))
    assert got == [("1", "a3", "b2", None, None), ("2", None, None, "c5", "d5")]
    with pytest.raises(ValueError):
        store.read("none", columns)


def test_unfinished_delta_is_ignored(spark, tmp_path):
    store = dims.DimStore(spark, str(tmp_path))
    store.upsert("d", 0, cells(spark, UPDATES), "id", "after", ["a"], "seq")
    torn = tmp_path / "delta" / "v=batch-1" / "table=d"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_text("torn")
    assert rows(store.read("d", ["a"], "id")) == [("1", "a3"), ("2", None)]


def test_store_loses_nothing(spark, tmp_path):
    """A rule that shrinks, a run that counts from 0 again, a late delta, two compactions."""
    store = dims.DimStore(spark, str(tmp_path))

    def put(run, batch, key, seq, after, columns):
        store.upsert("d", batch, cells(spark, [(key, seq, after)]), "id", "after", columns, "seq", run)

    def now():
        return rows(store.read("d", ["name", "segment"], "id"))

    put("a", 5, "1", 5, {"name": "ann", "segment": "x"}, ["name", "segment"])
    put("a", 6, "1", 6, {"name": "no", "segment": "y"}, ["segment"])
    store.compact()
    assert now() == [("1", "ann", "y")]
    put("b", 0, "2", 1, {"name": "bob"}, ["name"])  # a fresh checkpoint
    put("a", 3, "1", 7, {"name": "eve"}, ["name"])  # a lower number, written later
    put("b", 0, "2", 9, {"name": "again"}, ["name"])  # the batch comes again
    assert now() == [("1", "eve", "y"), ("2", "bob", None)]
    for _ in range(3):
        store.compact()
        assert now() == [("1", "eve", "y"), ("2", "bob", None)]
    put("b", 1, "2", 2, {"segment": "z"}, ["segment"])
    store.compact()
    assert now() == [("1", "eve", "y"), ("2", "bob", "z")]
    left = {p.name for p in (tmp_path / "delta").iterdir()}
    assert left == {"v=b-1"} and len(list((tmp_path / "base").iterdir())) == 2


def test_declared_tables(spark, tmp_path):
    store = dims.DimStore(spark, str(tmp_path))
    store.create_if_absent("t", cdc.sink_schema("name,code", "code"), "SALT_BUCKETS = 3")
    store.create_if_absent("t", ["other"])
    assert store.declared("t").names == ["name", "code"]
    assert store.declared("t")["name"].metadata["comment"] == "SALT_BUCKETS = 3"
    assert store.read("t", ["name"], "code").columns == ["code", "name"]


def test_loads(spark, tmp_path):
    source = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], "id INT, seq INT, v STRING")
    assert rows(loads.incremental(source, source.where("seq <= 20"), "seq"), "id") == [(3,)]
    assert loads.incremental(source, source.where("seq > 99"), "seq").count() == 3
    changed = spark.createDataFrame([(2, 25, "B"), (4, 40, "d"), (1, 5, "stale")], "id INT, seq INT, v STRING")
    merged = loads.new_and_changed(source, changed, "id", "seq")
    assert rows(merged) == [(1, 10, "a"), (2, 25, "B"), (3, 30, "c"), (4, 40, "d")]
    path = str(tmp_path / "once")
    assert loads.once(spark, source, path) is True
    assert loads.once(spark, changed, path) is False
    assert spark.read.parquet(path).count() == 3
    loads.full(changed, path)
    assert rows(spark.read.parquet(path), "v") == [("B",), ("d",), ("stale",)]
