"""Running sums with a hot key and late rows, over several micro-batches and a restart."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillhouse.operators import cdc, logs
from rillhouse.operators.ordered import running
from rillhouse.session import stream_session
from rillhouse.sources import committed, readers
from rillhouse.sources.writers import buffered_exact, flush_held
from rillhouse.streaming import jobs
from rillhouse.streaming.run import run_paced
from tests.conftest import at, rows


@pytest.fixture(scope="module")
def session(spark):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


def table(spark, path, data, schema):
    df = spark.createDataFrame(data, schema).coalesce(1)
    df.sortWithinPartitions("n").write.parquet(str(path))
    return df


def test_running_sums_go_on_over_batches_with_a_hot_key(spark, session, tmp_path):
    rng = random.Random(4)
    data = [
        (n, None if n % 50 == 7 else "hot" if n % 2 else f"k{rng.randrange(9)}",
         at(n * 600), None if n % 11 == 0 else n % 5)
        for n in range(600)
    ]
    df = table(spark, tmp_path / "t", data, "n long, key string, ts timestamp, v int")
    stream = readers.counter_stream(session, str(tmp_path / "t"), 130, "place").drop("place")
    sums = {"total": F.col("v"), "count": F.lit(1)}

    def write(done, batch):
        done.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch}")

    job = jobs.running_job(stream, "key", "ts", "n", sums, write, f"{tmp_path}/state")
    run_paced(job, stop_after=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.select("batch").distinct().count() >= 5
    columns = ["n", "key", "v", "total", "count"]
    assert rows(back, *columns) == rows(running(df, "key", "ts", "n", sums), *columns)


def test_running_job_has_no_python_in_its_plan(spark, session, tmp_path):
    table(spark, tmp_path / "t", [(1, "a", at(0), 1)], "n long, key string, ts timestamp, v int")
    plans = []

    def write(done, _):
        plans.append(done._jdf.queryExecution().executedPlan().toString())
        done.collect()

    stream = session.readStream.schema("n long, key string, ts timestamp, v int").parquet(str(tmp_path / "t"))
    run_paced(jobs.running_job(stream, "key", "ts", "n", {"s": F.col("v")}, write, f"{tmp_path}/c"))
    assert plans and not any("Python" in p or "Arrow" in p or "Pandas" in p for p in plans)


def test_late_rows_are_kept_apart(spark, session, tmp_path):
    # three batches of four: the second brings two rows back in time, the third one more
    times = [0, 30, 70, 100, 40, 110, 59, 200, 119, 121, 60, 300]
    data = [(n, at(t - 1_700_000_000 % 60)) for n, t in enumerate(times)]
    table(spark, tmp_path / "t", data, "n long, ts timestamp")
    stream = readers.counter_stream(session, str(tmp_path / "t"), 4, "place").drop("place")

    def write(on_time, late, batch):
        on_time.write.mode("overwrite").parquet(f"{tmp_path}/on/b={batch}")
        late.write.mode("overwrite").parquet(f"{tmp_path}/late/b={batch}")

    job = jobs.late_rows_job(
        stream, "ts", timedelta(seconds=60), timedelta(seconds=10), write, f"{tmp_path}/m",
        f"{tmp_path}/state",
    )
    run_paced(job, stop_after=1)
    late = {n for (n,) in rows(spark.read.schema("n long").parquet(f"{tmp_path}/late"), "n")}
    on_time = {n for (n,) in rows(spark.read.schema("n long").parquet(f"{tmp_path}/on"), "n")}
    want, mark = set(), None
    for batch in range(3):
        part = range(4 * batch, 4 * batch + 4)
        want |= {n for n in part if mark is not None and times[n] // 60 * 60 + 60 <= mark}
        mark = max(times[n] for n in range(4 * batch + 4)) - 10
    assert late == want and want and on_time == set(range(12)) - want


def test_messages_lose_nothing(spark):
    def sent(text, flag=None):
        flat = logs.parse_all(spark.createDataFrame([(text,)], "value string"))
        if flag is not None:
            flat = flat.withColumn("common", F.col("common").withField("is_new", F.lit(flag)))
        return {t: v for t, v in rows(logs.route_log(flat))}

    record = (
        '{"common":{"ext":{"q":1,"z":[1,{"a":null}]},"is_new":"1","sid":"} {"},"top":{"b":true},'
        '"page":{"page_id":"p"},"displays":[{"item":"1","extra":{"page_id":"x"},"page_id":"old"}]}'
    )
    as_it_came = sent(record)
    assert as_it_came[logs.TOPIC_PAGE] == record
    assert as_it_came[logs.TOPIC_DISPLAY] == '{"extra":{"page_id":"x"},"item":"1","page_id":"p"}'
    other = sent(record, "0")
    assert other[logs.TOPIC_PAGE].replace('"is_new":"0"', '"is_new":"1"') in (
        record.replace('"ext"', '"ext"'),
        record.replace('"extra":{"page_id":"x"},', "").replace('{"item":"1"', '{"extra":{"page_id":"x"},"item":"1"'),
    )
    assert '"top":{"b":true}' in other[logs.TOPIC_PAGE] and '"is_new":"0"' in other[logs.TOPIC_PAGE]
    assert sent("{broken")[logs.TOPIC_DIRTY] == "{broken"
    nested = sent('{"common":{"is_new":"1"},"start":{"entry":"a"},"x":1.5,"n":12345678901234567890}', "0")
    assert nested[logs.TOPIC_START] == (
        '{"common":{"is_new":"0"},"start":{"entry":"a"},"x":1.5,"n":12345678901234567890}'
    )


def test_counts_need_no_messages(spark):
    lines = spark.createDataFrame([('{"page":{"page_id":"p"}}',)], "value string")
    counted = logs.route_log(logs.parse_all(lines)).groupBy("topic").count()
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "VariantType" not in plan


def test_unreadable_changes_keep_their_text(spark):
    raw = [("s.d.t", '{"op":"c","after":{"id":"1"}}'), ("s.d.t", "{cut"), ("s.d.t", "[]"), ("s.d.t", None)]
    got = cdc.normalize_cdc(spark.createDataFrame(raw, "topic string, value string"), unreadable="text")
    want = [("insert", None), (None, "[]"), (None, None), (None, "{cut")]
    assert sorted(rows(got, "type", "text"), key=str) == sorted(want, key=str)


def test_first_of_keys_over_batches(spark, session, tmp_path):
    rng = random.Random(9)
    data = [
        (n, None if n % 40 == 3 else f"k{rng.randrange(25)}", at(n * 900 - (n % 4) * 600), n)
        for n in range(400)
    ]
    table(spark, tmp_path / "t", data, "n long, key string, ts timestamp, v long")

    def marked(name, **options):
        stream = readers.counter_stream(session, str(tmp_path / "t"), 90, "place").drop("place")

        def write(done, batch):
            done.write.mode("overwrite").parquet(f"{tmp_path}/{name}/batch={batch}")

        job = jobs.first_job(stream, ["key"], "ts", "n", write, f"{tmp_path}/{name}-c", **options)
        run_paced(job, stop_after=2)
        back = spark.read.parquet(f"{tmp_path}/{name}").where("n is not null")
        assert back.count() == len(data)
        return {n for n, first in rows(back, "n", "first") if first}

    def wanted(cell):
        seen, want = set(), set()
        for begin in range(0, 400, 90):
            part = sorted(data[begin : begin + 90], key=lambda r: (r[2], r[0]))
            new = {}
            for n, key, ts, _ in part:
                new.setdefault((key, cell(ts)), n)
            want |= {n for k, n in new.items() if k not in seen}
            seen |= set(new)
        return want

    assert marked("ever") == wanted(lambda ts: 0)
    day = timedelta(days=1)
    per_day = marked("daily", per=day, lateness=timedelta(hours=2))
    assert per_day == wanted(lambda ts: ts.date())


@pytest.mark.parametrize("stop_after", [None, 2])
def test_files_of_exactly_the_threshold(spark, session, tmp_path, stop_after):
    data = [(n, at(n)) for n in range(107)]
    df = table(spark, tmp_path / "t", data, "n long, ts timestamp")
    stream = readers.counter_stream(session, str(tmp_path / "t"), 23, "place").drop("place")
    out, held = str(tmp_path / "out"), str(tmp_path / "held")
    run_paced(buffered_exact(stream, ["n"], out, held, f"{tmp_path}/c", 10), stop_after)
    flush_held(spark, df.schema, out, held, 4)
    sizes = sorted(len(f.read_text().splitlines()) for f in (tmp_path / "out").rglob("*.json"))
    assert [n for n in sizes if n] == [7, *[10] * 10]
    back = spark.read.schema(df.schema).option("recursiveFileLookup", "true").json(out)
    assert sorted(n for (n,) in rows(back, "n")) == list(range(107))


def test_a_held_buffer_is_flushed_by_time(spark, session, tmp_path):
    table(spark, tmp_path / "t", [(n, at(n * 10)) for n in range(12)], "n long, ts timestamp")
    stream = readers.counter_stream(session, str(tmp_path / "t"), 3, "place").drop("place")
    out = str(tmp_path / "out")
    run_paced(buffered_exact(
        stream, ["n"], out, str(tmp_path / "h"), f"{tmp_path}/c", 100, "ts", timedelta(seconds=45)))
    files = [sorted(spark.read.json(str(f)).toPandas()["n"]) for f in (tmp_path / "out").rglob("*.json")
             if f.stat().st_size]
    assert sorted(files) == [[0, 1, 2, 3, 4, 5], [6, 7, 8, 9, 10, 11]]


def test_batches_count_as_a_whole_and_once(spark, session, tmp_path):
    import pyarrow as pa

    path = str(tmp_path / "sink")
    writer = committed.BatchWriter({"path": path, "transient": "t"}, ["a", "t"])
    batch = pa.RecordBatch.from_pydict({"a": [1, 2], "t": ["x", "y"]})
    schema = spark.createDataFrame([(1,)], "a long").schema

    def read():
        return sorted(r.a for r in committed.read_committed(spark, path, schema).collect())

    one, none = writer.write(iter([batch, batch])), writer.write(iter([]))
    lost = writer.write(iter([batch]))
    writer.commit([one, none], 0)
    assert read() == [1, 1, 2, 2]
    writer.abort([lost, None], 1)  # a batch that failed
    assert read() == [1, 1, 2, 2] and len(list((tmp_path / "sink" / "rows").iterdir())) == 1
    writer.commit([writer.write(iter([batch]))], 0)  # the batch comes again
    assert read() == [1, 1, 2, 2] and len(list((tmp_path / "sink" / "rows").iterdir())) == 1
    writer.commit([writer.write(iter([batch]))], 1)
    assert read() == [1, 1, 1, 2, 2, 2]
    with pytest.raises(ValueError, match="not in the record"):
        committed.BatchWriter({"path": path, "transient": "z"}, ["a"])


def test_a_job_goes_on_from_the_state_of_another(spark, session, tmp_path):
    data = [
        (n, None if n % 9 == 0 else "hot" if n % 2 else f"k{n % 7}", at(n), n % 5) for n in range(120)
    ]
    schema = "n long, key string, ts timestamp, v int"
    whole = spark.createDataFrame(data, schema)
    sums = {"total": F.col("v"), "count": F.lit(1)}
    base, got = str(tmp_path / "base"), []
    for name, part, partitions in (("a", data[:70], 2), ("b", data[70:], 5)):
        table(spark, tmp_path / name, part, schema)
        own = stream_session(spark, partitions)
        stream = readers.counter_stream(own, str(tmp_path / name), 40, "place").drop("place")

        def write(done, batch, name=name):
            done.write.mode("overwrite").parquet(f"{tmp_path}/{name}-out/batch={batch}")

        state = f"{tmp_path}/{name}-state"
        start = base if got else None
        run_paced(jobs.running_job(stream, "key", "ts", "n", sums, write, state, start), 1)
        got.append(spark.read.parquet(f"{tmp_path}/{name}-out"))
        if name == "a":
            totals = jobs.totals_of(spark, state, whole.schema["key"], list(sums))
            assert rows(totals) == rows(
                spark.createDataFrame(data[:70], schema).groupBy("key").agg(
                    F.sum("v"), F.count("*")))
            jobs.save_totals(spark, state, whole.schema["key"], list(sums), base)
    columns = ["n", "key", "total", "count"]
    found = got[0].unionByName(got[1])
    assert rows(found, *columns) == rows(running(whole, "key", "ts", "n", sums), *columns)
