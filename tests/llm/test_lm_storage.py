"""Copies that language-model scoring keeps to its end are packed well."""

import os

from rillhouse.llm import lm_scoring
from rillhouse.session import shared_dir


def test_blocks_and_counts_are_stored_with_zstd(spark):
    docs = spark.createDataFrame([(n, f"some words of text {n}") for n in range(20)], "doc_id long, text string")
    before = set(os.listdir(shared_dir(spark)))
    lm_scoring.score(docs, docs.where("doc_id < 5").select("doc_id")).collect()
    made = set(os.listdir(shared_dir(spark))) - before
    for label in ("lm-blocks", "lm-counts"):
        files = [
            f for d in made if d.startswith(label)
            for f in os.listdir(f"{shared_dir(spark)}/{d}") if f.endswith(".parquet")
        ]
        assert files and all(".zstd." in f for f in files)
