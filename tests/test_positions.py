"""Sources with positions of their own, over several micro-batches and restarts."""

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from rillhouse.session import stream_session
from rillhouse.sources import positions, readers
from rillhouse.sources.readers import Endpoint
from rillhouse.sources.writers import write_batch_topics
from rillhouse.streaming.run import drain_paced
from tests.conftest import rows


@pytest.fixture(scope="module")
def session(spark):
    return stream_session(spark)


def topic_file(root, topic, run, batch, name, lines, end="\n"):
    folder = root / f"topic={topic}" / f"run={run}" / f"batch={batch}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes((end.join(lines) + end).encode())


@pytest.mark.parametrize("step", [1, 3, 7, 1000])
def test_every_line_belongs_to_one_stretch(tmp_path, step):
    texts = ["", "a", "déjà vu", "", "x" * 40, "last without end"]
    path = tmp_path / "f"
    path.write_bytes("\n".join(texts).encode())
    size = path.stat().st_size
    with pafs.LocalFileSystem().open_input_file(str(path)) as source:
        found = [positions.lines_of(source, a, min(a + step, size)) for a in range(0, size, step)]
    lines = [x for part, _ in found for x in part]
    places = [p for _, part in found for p in part]
    assert lines == texts and places == sorted(set(places))
    assert [path.read_bytes()[p:].split(b"\n")[0].decode() for p in places] == texts


def test_positions_over_batches_files_and_a_restart(spark, session, tmp_path):
    want = []
    for run in ("r1", "r2"):
        for batch in (9, 10, 2):  # numbers, not texts: 2, 9, 10
            for part in range(2):
                lines = [f"{run}-{batch:03d}-{part}-{i:03d}" for i in range(40)]
                topic_file(tmp_path, "t", run, batch, f"part-{part}", lines, "\r\n" if part else "\n")
                want += lines
    topic_file(tmp_path, "other", "r1", 0, "part-0", ["no"])
    (tmp_path / "topic=t" / "_SUCCESS").write_text("not a record")
    found = readers.topic_stream(
        session, Endpoint("files", str(tmp_path), {"bytesPerTask": "100"}), "t", per_batch=700
    )
    back = drain_paced(spark, found, "positions", stop_after=2)
    got = [tuple(r) for r in back.select("run", "offset", "value").collect()]
    assert sorted(v for *_, v in got) == sorted(want)
    assert len({(r, o) for r, o, _ in got}) == len(got)
    for run in ("r1", "r2"):
        assert [v for r, _, v in sorted(got) if r == run] == sorted(v for v in want if v.startswith(run))


def test_more_files_are_followed_and_changed_ones_fail(spark, session, tmp_path):
    reader = positions.TopicReader({"path": str(tmp_path), "topics": "t", "bytesperbatch": "5"})
    assert reader.latestOffset() == {}
    topic_file(tmp_path, "t", "r", 1, "a", ["one", "two", "three"])
    seen, start = [], reader.initialOffset()
    for _ in range(10):
        end = reader.latestOffset()
        if end == start:
            break
        assert reader.latestOffset() == end  # asking does not move it
        for part in reader.partitions(start, end):
            for batch in reader.read(part):
                seen += batch.column("value").to_pylist()
        reader.commit(end)
        start = end
    assert seen == ["one", "two", "three"]
    topic_file(tmp_path, "t", "r", 2, "a", ["four"])
    again = positions.TopicReader({"path": str(tmp_path), "topics": "t"})
    again.partitions(start, start)  # what the engine tells a source that starts again
    end = again.latestOffset()
    (part,) = again.partitions(start, end)
    assert [b.column("value").to_pylist() for b in again.read(part)] == [["four"]]
    topic_file(tmp_path, "t", "r", 0, "a", ["earlier"])
    with pytest.raises(ValueError, match="have changed"):
        again.latestOffset()


def test_numbered_rows(spark, session, tmp_path):
    path = str(tmp_path / "table")
    for k in range(3):
        part = spark.range(k * 100, k * 100 + 100, numPartitions=2).withColumn("t", F.lit("x"))
        part.write.mode("append").option("parquet.block.size", 1024).parquet(path)
    found = readers.counter_stream(session, path, 70)
    back = drain_paced(spark, found, "numbered", stop_after=2)
    got = rows(back, "value", "id")
    assert sorted(v for v, _ in got) == list(range(300))
    assert sorted(i for _, i in got) == list(range(300))
    reader = positions.RowReader({"path": path, "rowsperbatch": "70"})
    steps = []
    while not steps or steps[-1] < 300:
        steps.append(reader.latestOffset()["row"])
        reader.commit({"row": steps[-1]})
    assert steps == [70, 140, 210, 280, 300]
    with pytest.raises(Exception, match="has a column id"):
        readers.counter_stream(session, path, 70, "id")


def test_counter_numbers_rows_in_order(spark):
    data = [(i * 7919 % 1000, None if i % 10 == 0 else "x") for i in range(1000)]
    got = rows(readers.counter(spark.createDataFrame(data, "k long, v string").repartition(7), "k"))
    assert sorted((v, k) for v, k, _ in got) == [(i, i) for i in range(1000)]
    empty = spark.createDataFrame([], "k long")
    assert rows(readers.counter(empty, "k")) == []


def test_a_write_outside_a_stream_names_its_run(spark, tmp_path):
    one = spark.createDataFrame([("t", "a")], "topic STRING, value STRING")
    target = Endpoint("files", str(tmp_path))
    with pytest.raises(ValueError, match="name the run"):
        write_batch_topics(one, target, 0)
    write_batch_topics(one, target, 0, "x")
    write_batch_topics(one, target, 0, "y")
    assert readers.text_batch(spark, target, "t").count() == 2
