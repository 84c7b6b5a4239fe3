"""The timed entry pattern with keys that share a bucket."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillhouse.operators.ordered import entry_pattern
from rillhouse.streaming import forms
from tests.conftest import rows
from tests.test_ordered import SCHEMA, made
from tests.test_streams import END, KEEP, Feed, batches, run, session  # noqa: F401


@pytest.mark.parametrize("buckets", [1, 3])
def test_keys_of_a_bucket_are_decided_apart(spark, session, tmp_path, buckets):  # noqa: F811
    horizon = timedelta(seconds=10)
    feed = Feed(spark, session, tmp_path / "in", SCHEMA)
    data = made(300, span=2000)
    for part in batches(data, 2):
        feed.put(part)
    feed.put([END])
    found = forms.entry_pattern_timed(
        feed.stream, "mid", "ts", "tie", F.col("entry"), horizon, KEEP, buckets=buckets
    )
    got = run(found, tmp_path / "out")(spark)
    plain = spark.createDataFrame([r for r in data if r[0]], SCHEMA)
    want = entry_pattern(plain, "mid", "ts", "tie", F.col("entry"), horizon)
    assert rows(got, "tie", "how") == rows(want, "tie", "how")
