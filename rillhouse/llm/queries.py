"""Queries of the operators over their whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.llm import (
    ann_search,
    hard_negatives,
    html_extract,
    lm_scoring,
    mixing,
    mixture_packing,
    packing,
    phrases,
    pq_dedup,
    simhash,
    substring,
    token_files,
    toxicity,
)
from rillhouse.llm.common import stored, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    good = table(spark, sf, "labels").where("quality = 1")
    return lm_scoring.score(docs, good).drop("text")


def op4_main_text(spark: SparkSession, sf: str) -> DataFrame:
    found = html_extract.main_text(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def packed_digest(docs: DataFrame) -> DataFrame:
    """The places of all pieces, with a digest of their ids instead of the ids."""
    cut = stored(packing.pieces(docs, vocabulary("byte_bpe_50k.json")), "pack-pieces")
    slim = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(slim).withColumn("length", F.col("length").cast("long"))


def op5_pack_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    return packed_digest(table(spark, sf, "documents"))


def op6_ann_search(spark: SparkSession, sf: str) -> DataFrame:
    return ann_search.search(table(spark, sf, "embeddings"))


def op7_vector_groups(spark: SparkSession, sf: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf, "embeddings"))


def op8_remove_repeats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    written = token_files.write(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))
    return token_files.read(written).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(hard_negatives.quantised(rows))


def op12_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = mixture_packing.pack(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    found = phrases.top(phrases.mine(table(spark, sf, "documents")))
    return found.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_toxicity,
        op3_lm_scores,
        op4_main_text,
        op5_pack_best_fit,
        op6_ann_search,
        op7_vector_groups,
        op8_remove_repeats,
        op9_simhash,
        op10_token_files,
        op11_hard_negatives,
        op12_mixture_packing,
        op13_collocations,
    )
}

ORACLE: dict[str, str] = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, text, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sums),
parts AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS part FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, (SELECT part FROM parts WHERE part * weight <= cap
    ORDER BY cap / weight, source NULLS LAST LIMIT 1) AS level FROM parts),
targets AS (
  SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target,
    CASE WHEN source_size > 0 THEN least(cap, coalesce(level * weight, cap)) / source_size
      ELSE 0 END AS rate FROM levels),
drawn AS (
  SELECT *, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR,
    't' || md5(coalesce(text, '')))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw FROM sized)
SELECT doc_id, size, source_size, target,
  (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies,
  (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM drawn JOIN targets ON drawn.source IS NOT DISTINCT FROM targets.source""",
    "op11_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding]::DOUBLE[] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id
    ORDER BY score DESC, vec_id)::INTEGER AS rank
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS b FROM words),
grams AS (
  SELECT lang, m, array_to_string(w[b:b + m - 1], ' ') AS phrase
  FROM places, (SELECT unnest(range(1, 6)) AS m) WHERE b + m - 1 <= len(w)),
counts AS (
  SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS w
  FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM counts WHERE m > 1),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
    (1000 * c.f::HUGEINT * n) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[b:b + s - 1], ' ') AS phrase, max(f) AS g
  FROM (SELECT lang, w, f, m, s, unnest(range(1, m - s + 2)) AS b
    FROM (SELECT *, unnest(range(2, m)) AS s FROM counts WHERE m > 2))
  GROUP BY ALL)
SELECT s.lang, s.phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score,
  row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
FROM scored s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE g IS NULL OR 100 * g < 100 * a
QUALIFY rank <= 2000""",
}
