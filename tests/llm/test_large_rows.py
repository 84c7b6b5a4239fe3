"""Tables of large rows are stored so that a task need not hold many of them at once."""

import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rillhouse.llm import common, phrases


def test_blocks_lie_in_small_row_groups(spark, documents, monkeypatch):
    rng, found = random.Random(3), {}
    texts = [" ".join(f"{rng.getrandbits(64):016x}" for _ in range(60_000)) + "." for _ in range(20)]
    texts.append("one two. " * 150)

    def kept(df, label, *args, **options):
        found[label] = common.stored(df, label, *args, **options)
        return found[label]

    monkeypatch.setattr(phrases, "stored", kept)
    docs = documents(list(enumerate(texts))).coalesce(1)
    got = phrases.mine(docs).collect()
    assert [(r.phrase, r.a) for r in got] == [("one two", 150)]
    blocks = found["phrase-blocks"]
    assert blocks.agg(F.sum("n_words")).first()[0] == 20 * 60_000 + 300
    groups = [
        meta.row_group(k).total_byte_size
        for meta in (pq.read_metadata(f.removeprefix("file:")) for f in blocks.inputFiles())
        for k in range(meta.num_row_groups)
    ]
    assert len(groups) > 1 and max(groups) <= 10 << 20
