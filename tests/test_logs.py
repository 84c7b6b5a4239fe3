import json

from pyspark.sql import functions as F

from rillhouse.functions.scalar import is_json_object
from rillhouse.operators import logs
from tests.conftest import rows

GOOD = [
    '{"a":1}', ' {"a":1} ', '\t{"a":{"b":[1,2]}}\n', "{}", '{"a":"}],[{"}', '{"a":"x\\"y"}',
]
BAD = [
    None, "", " ", "null", "1", '"x"', "[]", '[{"a":1}]', '{"a":1} x', '{"a":1}{"b":2}',
    '{"a":1},{"b":2}', '{"a":1},"b":2', '{"a":1}],[{"b":2}', '{"a":1}},{"b":2', '{"a":1',
    '{"a"}', "{a:1}", '{"a":1}]', '{"a":1}}', '{"a":1},', ',{"a":1}', '{"a":1,"a":2}', "text",
    '{"a":1}} , "x":{"y":1', '{"a":1}, "_":{"b":2}',
]


def test_strict_json_objects(spark):
    df = spark.createDataFrame([(v,) for v in GOOD + BAD], "v STRING")
    got = {r.v: r.ok for r in df.select("v", is_json_object("v").alias("ok")).collect()}
    assert got == {**{v: True for v in GOOD}, **{v: False for v in BAD}}


def lines(spark):
    common = {"mid": "m1", "is_new": "1", "ar": "1", "ch": "2", "vc": "3"}
    records = [
        {"common": common, "start": {"entry": "icon", "loading_time": 5}, "ts": 1,
         "displays": [{"item": "never"}]},
        {"common": common, "start": {}, "ts": 2},
        {"common": common, "page": {"page_id": "home"}, "ts": 3,
         "displays": [{"item": "1", "order": 1}, {"item": "2", "order": 2}]},
        {"common": common, "page": {"page_id": "cart", "last_page_id": "home"}, "ts": 4,
         "displays": [], "actions": [{"action_id": "buy", "ts": 9}]},
        {"common": common, "ts": 5, "displays": [{"item": "3"}]},
        {"common": common, "page": {"page_id": "p", "last_page_id": ""}, "ts": 6,
         "err": {"error_code": 3, "msg": "no"}},
    ]
    text = [json.dumps(r) for r in records] + ["broken", "", '[{"ts":7}]']
    return spark.createDataFrame(list(enumerate(text)), "pos BIGINT, value STRING")


def test_splits(spark):
    parsed = logs.parse_all(lines(spark))
    clean = logs.clean_records(parsed)
    assert rows(logs.dirty_records(parsed), "pos", "value") == [(6, "broken"), (7, ""), (8, '[{"ts":7}]')]
    split = logs.split_log(clean)
    assert rows(split[logs.TOPIC_START], "ts") == [(1,), (2,)]
    assert rows(split[logs.TOPIC_PAGE], "ts") == [(3,), (4,), (5,), (6,)]
    assert rows(split[logs.TOPIC_DISPLAY], "item", "page_id") == [("1", "home"), ("2", "home"), ("3", None)]
    assert rows(split[logs.TOPIC_ACTION], "action_id", "ts", "page_id") == [("buy", 9, "cart")]
    assert rows(split[logs.TOPIC_ERROR], "ts", "err.error_code") == [(6, 3)]


def test_one_pass_routing_equals_the_splits(spark):
    parsed = logs.parse_all(lines(spark))
    routed = logs.route_log(parsed)
    by_topic = {r.topic: r.n for r in routed.groupBy("topic").agg(F.count("value").alias("n")).collect()}
    want = {t: d.count() for t, d in logs.split_log(logs.clean_records(parsed)).items()}
    assert by_topic == {**want, logs.TOPIC_DIRTY: 3}
    shown = [json.loads(r.value) for r in routed.where(F.col("topic") == logs.TOPIC_DISPLAY).collect()]
    assert sorted((d["item"], d.get("page_id")) for d in shown) == [("1", "home"), ("2", "home"), ("3", None)]
    pages = [json.loads(r.value) for r in routed.where(F.col("topic") == logs.TOPIC_PAGE).collect()]
    assert {p["ts"] for p in pages} == {3, 4, 5, 6}
    assert rows(routed.where(F.col("topic") == logs.TOPIC_DIRTY), "value") == [
        ("",), ("[{\"ts\":7}]",), ("broken",)
    ]


def test_filters_do_not_parse_again(spark):
    pages = logs.page_log(logs.parse_log(lines(spark)))
    plan = pages.where("page.page_id = 'home'")._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("from_json") == 1
    assert plan.count("parseJson") == 1


def test_entry_page(spark):
    pages = logs.page_log(logs.parse_log(lines(spark)))
    assert rows(pages.where(logs.is_entry()), "ts") == [(3,), (5,), (6,)]


def test_dirty_rate(spark):
    marked = logs.mark_dirty(lines(spark))
    assert rows(logs.dirty_rate(marked)) == [(9, 3, 3 / 9)]


def test_fields_outside_the_schema_stay(spark):
    texts = [
        '{"common":{"sid":"s","is_new":"1","mid":"m"},"page":{"page_id":"p","source_type":"q"},"more":[1,{"a":2}],"ts":1,'
        '"displays":[{"item":"1","x":{"y":1}},{},{"item":"2"}],"actions":[{"action_id":"a","z":7}]}',
        '{"common":{"mid":"m"},"start":{"entry":"icon","w":1.50},"ts":2}',
        '{"common":{"is_new": null},"page":{},"displays":[{"page_id":"own","item":"3"}]}',
    ]
    parsed = logs.parse_all(spark.createDataFrame([(t,) for t in texts], "value STRING"))
    flag = F.when(F.col("common.is_new") == "1", "0").otherwise(F.col("common.is_new"))
    routed = logs.route_log(parsed.withColumn("common", F.col("common").withField("is_new", flag)))
    got = {}
    for r in routed.collect():
        got.setdefault(r.topic, []).append(json.loads(r.value))
    want = [json.loads(t) for t in texts]
    want[0]["common"]["is_new"] = "0"
    assert got["dwd_page_log"] == [want[0], want[2]]
    assert got["dwd_start_log"] == [want[1]]
    assert got["dwd_display_log"][:3] == [{**d, "page_id": "p"} for d in want[0]["displays"]]
    assert got["dwd_display_log"][3]["item"] == "3"
    assert got["dwd_action_log"] == [{"action_id": "a", "z": 7, "page_id": "p"}]
