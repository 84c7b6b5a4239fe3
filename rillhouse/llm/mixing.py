"""Mixing of sources to target weights, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import WORD, lookup, stored

#: Of documents whose id is unknown the draw is seeded by the text.
_SEED = "coalesce(cast(doc_id as string), concat('t', md5(coalesce(text, ''))))"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(salt: str) -> Column:
    """A number in [0, 1) that depends on the document and ``salt`` alone."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.expr(_SEED)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(source, source_size, target, rate)``, one row per source, from ``sized(source, size)``.

    Sources in order of code points, null last, take the ``weights`` in turn and share ``share``
    times all sizes. A target stops at ``most`` times the source's size; what is above goes to the
    others by weight. In closed form: in order of size per weight, the first source that its part
    of what remains does not fill ends the stopped ones, and its part per weight holds for all
    after it. Only the one-row-per-source summary meets in one task, never documents.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    caps = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    by_fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    parts = caps.select(
        "*",
        (
            (
                F.sum("source_size").over(whole) * F.lit(share)
                - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
            )
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        ).alias("part"),
    ).withColumn("open", F.col("part") * F.col("weight") <= F.col("cap"))
    level = F.first(F.when(F.col("open"), F.col("part")), ignorenulls=True).over(
        by_fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return parts.select("source", "source_size", target.alias("target")).withColumn(
        "rate",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
    )


def mix(docs: DataFrame, salt: str = "mix", share: float = 1.5) -> DataFrame:
    """Each document with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``.

    ``copies`` is the whole part of the source's rate, and one more with the probability of the
    rest, drawn from a hash of the document: the same document draws the same in every run, and
    repeated rows draw alike. A null text has size 0; null is a source of its own; a source without
    a word has rate 0. Columns of the input with these names are replaced; an empty table gives an
    empty result.
    """
    made = ["size", "source_size", "target", "rate", "copies"]
    plain = docs.drop(*made)
    targets = stored(
        source_targets(plain.select("source", n_words().alias("size")), share=share), "mix-targets"
    )
    rated = lookup(plain.withColumn("size", n_words()), targets, "source")
    whole = F.floor("rate")
    copies = whole + (draw(salt) < F.col("rate") - whole).cast("long")
    return rated.withColumn("copies", copies)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document ``copies`` times."""
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("_copy")
