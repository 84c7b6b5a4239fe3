"""Phrases that stand together more often than their parts would by chance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import arrow_rows, row_bytes, sized, stored, tidy

#: About so many bytes of text make up one block, within which equal n-grams are counted first.
BLOCK_BYTES = 1 << 19
#: Blocks that are sent to a worker at once.
BATCH_BLOCKS = 8
#: Blocks are stored in row groups of about so many bytes, of which a task holds one.
GROUP_BYTES = 8 << 20
#: The filter of frequent n-grams that is sent to the workers has 2^26 bits, which are 8 MB.
FILTER_BITS = 26
#: Bits of one native bitmap (a fixed value of the aggregate that builds them).
NATIVE_BITS = 32_768

_BLANKS, _BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64 given."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were asked for so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 20)
            factors = np.array([[_BASE], [pow(_BASE, -1, 1 << 64)]], np.uint64)
            table = np.repeat(factors, size, axis=1)
            table[:, 0] = 1
            cls.up, cls.down = np.cumprod(table, axis=1, dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


class Ranges:
    """Polynomial fingerprints of any range of a sequence, from the prefixes' polynomials."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        up, self.down = Powers.of(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.prefix[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[begin]) * self.down[begin]


class Block:
    """The words of a block of text, which ends with a break, and fingerprints of its n-grams.

    ``bits`` is the width of a fingerprint; fewer bits only make more n-grams share one.
    """

    def __init__(self, text: bytes, lang: str, bits: int = 64) -> None:
        self.text = np.frombuffer(text, np.uint8)
        self.begin, self.end, kinds = word_edges(self.text)
        self.piece = np.cumsum(kinds == 2, dtype=np.int32)[self.begin]
        self.shift, self.slot = _U(64 - bits), _U(max(0, bits - FILTER_BITS))
        sizes = (self.end - self.begin).astype(np.uint64)
        self.prints = mixed(Ranges(self.text).of(self.begin, self.end) + sizes * _U(_BASE))
        self.ranges = Ranges(self.prints)
        seed = Ranges(np.frombuffer(lang.encode(), np.uint8)).prefix[-1:]
        self.seed = mixed(seed + _U(len(lang) + 1))[0]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of all n-grams within pieces, and their fingerprints."""
        last = max(0, len(self.begin) - n + 1)
        at = np.flatnonzero(self.piece[n - 1 :][:last] == self.piece[:last])
        prints = mixed(self.ranges.of(at, at + n) + self.seed + _U(n)) >> self.shift
        return at, prints

    def known(self, prints: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Which fingerprints the filter has."""
        slots = prints >> self.slot
        return bits[slots >> _U(3)] >> (slots & _U(7)).astype(np.uint8) & 1 == 1

    def counted(self, lengths: range, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different fingerprints of n-grams of some lengths, and how often each occurs.

        ``bits`` has the frequent n-grams of one word less than the first length; n-grams that hold
        another are left out.
        """
        found = []
        inner = lengths[0] - 1
        if inner:
            at, prints = self.grams(inner)
            run = np.zeros(len(self.begin) + 1, bool)
            run[at[self.known(prints, bits)]] = True
        for n in lengths:
            at, prints = self.grams(n)
            if inner:
                whole = run[at]
                for k in range(1, n - inner + 1):
                    whole &= run[at + k]
                prints = prints[whole]
            found.append(prints)
        prints = np.sort(np.concatenate(found))
        first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]][: len(prints)])
        return prints[first], np.diff(np.r_[first, len(prints)])

    def named(self) -> np.ndarray:
        """Numbers of words: two have the same only if their texts are the same."""
        prints, rest, given = self.prints >> self.shift, np.arange(len(self.begin)), 0
        names = np.empty(len(rest), np.int32)
        while len(rest):
            _, first, which = np.unique(prints[rest], return_index=True, return_inverse=True)
            same = self._same_text(rest, rest[first][which])
            names[rest[same]] = given + which[same]
            rest, given = rest[~same], given + len(first)
        return names

    def _same_text(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sizes = self.end[left] - self.begin[left]
        same = sizes == self.end[right] - self.begin[right]
        alike = np.flatnonzero(same)
        # bytes are compared for some words at a time, so that little memory is taken
        cuts = np.searchsorted(np.cumsum(sizes[alike]), np.arange(1, len(self.text), 1 << 17))
        for part in np.split(alike, np.unique(cuts)):
            if not len(part):
                continue
            length = sizes[part]
            begins = np.cumsum(length) - length
            steps = np.arange(length.sum()) - np.repeat(begins, length)
            ours = self.text[np.repeat(self.begin[left[part]], length) + steps]
            theirs = self.text[np.repeat(self.begin[right[part]], length) + steps]
            same[part] = np.logical_and.reduceat(ours == theirs, begins)
        return same

    def verified(self, longest: int, bits: np.ndarray):
        """``(n, pointers, counts)`` for each length: the n-grams whose fingerprint is frequent.

        All occurrences of a fingerprint are held against the words at its first one, which is
        what the pointer names; those that differ are counted apart, by a pointer of their own.
        """
        words = self.named()
        for n in range(1, longest + 1):
            at, prints = self.grams(n)
            kept = self.known(prints, bits)
            at, prints = at[kept], prints[kept]
            while len(at):
                _, first, which = np.unique(prints, return_index=True, return_inverse=True)
                pair = at[first][which]
                same = np.ones(len(at), bool)
                for k in range(n):
                    same &= words[at + k] == words[pair + k]
                yield n, at[first], np.bincount(which[same], minlength=len(first))
                at, prints = at[~same], prints[~same]

    def phrases(self, at: np.ndarray, n: int) -> list[str]:
        """The texts of the n-grams that begin at some words."""
        text, begin, end = self.text.tobytes(), self.begin, self.end
        cuts = [(begin[at + k].tolist(), end[at + k].tolist()) for k in range(n)]
        parts = [[text[a:b] for a, b in zip(*cut, strict=True)] for cut in cuts]
        return [b" ".join(words).decode() for words in zip(*parts, strict=True)]


def word_edges(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and what kind each byte is. The text ends with a break."""
    kinds = _KIND[text]
    edges = np.diff((kinds == 0).view(np.int8), prepend=np.int8(0))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), kinds


def pieces_of(text: bytes, limit: int):
    """A long text cut at characters that end a piece; no n-gram reaches over one."""
    marks = [bytes([c]) for c in _BREAKS]
    begin = 0
    while len(text) - begin > limit:
        cut = max(text.rfind(m, begin, begin + limit) for m in marks)
        if cut < 0:
            later = [text.find(m, begin + limit) for m in marks]
            cut = min((c for c in later if c >= 0), default=len(text) - 1)
        yield text[begin : cut + 1]
        begin = cut + 1
    yield text[begin:]


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(lang, text, n_words)``: lower-cased texts of one language, joined by newlines."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )

    def run(batches):
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def out(lang: str) -> pa.RecordBatch:
            sizes.pop(lang)
            text = _LOWER[np.frombuffer(b"\n".join([*held.pop(lang), b""]), np.uint8)]
            row = (lang, text.tobytes(), len(word_edges(text)[0]))
            kinds = [pa.string(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                ["lang", "text", "n_words"],
            )

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text")
            for lang, whole in zip(langs, texts, strict=True):
                for text in pieces_of(whole.as_py(), block_bytes):
                    held.setdefault(lang, []).append(text)
                    sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                    if sizes[lang] >= block_bytes:
                        yield out(lang)
                    if sum(sizes.values()) > 8 * block_bytes:
                        yield out(max(sizes, key=sizes.get))
        for lang in sorted(held):
            yield out(lang)

    return texts.mapInArrow(tidy(run), "lang string, text binary, n_words long")


def frequent(
    rows: DataFrame, lengths: range, known: np.ndarray, least: int, bits: int
) -> np.ndarray:
    """The filter's bits of the n-grams that may occur ``least`` times, by fingerprint.

    Blocks send a fingerprint once with its count; the sums never meet on the driver, only the
    bits of the frequent ones do. Their size is fixed, whatever they hold.
    """

    def run(batches):
        for block in blocks_of(batches, bits):
            prints, times = block.counted(lengths, known)
            signed = prints.view(np.int64)
            if bits <= 32:
                signed = prints.astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed), pa.array(times.astype(np.int32))], ["fp", "times"]
            )

    kind = "int" if bits <= 32 else "long"
    found = rows.select("lang", "text").mapInArrow(tidy(run), f"fp {kind}, times int")
    sums = found.groupBy("fp").agg(F.sum("times").alias("total")).where(F.col("total") >= least)
    slot = F.shiftrightunsigned("fp", max(0, bits - FILTER_BITS))
    maps = (
        sums.select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / NATIVE_BITS).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg((F.col("slot") % NATIVE_BITS).cast("long")).alias("bits"))
    )
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    size = NATIVE_BITS // 8
    for part, set_bits in maps.collect():
        whole[part * size : (part + 1) * size] = np.frombuffer(bytes(set_bits), np.uint8)
    return whole


def blocks_of(batches, bits: int):
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            yield Block(text.as_py(), lang.as_py(), bits)


def materialised(
    rows: DataFrame, known: np.ndarray, least: int, longest: int, bits: int
) -> DataFrame:
    """``(lang, phrase, n, f)``: the frequent n-grams as texts, and how often each text occurs.

    A block gives a text once, cut at its pointer and verified against all its occurrences; sums
    are by text, so phrases that share a fingerprint part, and what only shared it goes.
    """

    def run(batches):
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                block = Block(text.as_py(), lang.as_py(), bits)
                for n, at, times in block.verified(longest, known):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang.as_py()] * len(at), pa.string()),
                            pa.array(block.phrases(at, n), pa.string()),
                            pa.array(np.full(len(at), n, np.int32)),
                            pa.array(times.astype(np.int64)),
                        ],
                        ["lang", "phrase", "n", "times"],
                    )

    named = rows.select("lang", "text").mapInArrow(
        tidy(run), "lang string, phrase string, n int, times long"
    )
    summed = named.groupBy("lang", "phrase", "n").agg(F.sum("times").alias("f"))
    return summed.where(F.col("f") >= least)


def scored(counts: DataFrame, words: DataFrame, longest: int = 5) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of all phrases of two words or more.

    ``counts`` are the phrases of 1 to ``longest`` words with their counts ``f``, ``words`` has the
    number ``total`` of words of each language. Of the cuts of a phrase the one with the lowest score
    counts. A phrase that a longer one holds with the same count goes.
    """
    split = F.split("phrase", " ")
    several = counts.where("n >= 2").withColumn("w", split)
    cut = several.select(
        "lang", "phrase", "n", F.col("f").alias("a"), "w",
        F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "n", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("right"),
    )
    part, size = counts.select("lang", "phrase", "f"), counts.count() * row_bytes(counts)
    joined = cut.join(sized(part.toDF("lang", "left", "l"), size), ["lang", "left"]).join(
        sized(part.toDF("lang", "right", "r"), size), ["lang", "right"]
    )
    whole = joined.join(words, "lang")
    # floor(floor(x / l) / r) is floor(x / (l * r)), and no product passes 38 digits
    product = F.expr("cast(a as decimal(18,0)) * cast(total as decimal(17,0)) * 1000")
    scores = whole.withColumn("x", product.cast("decimal(38,0)")).withColumn(
        "score", quotient(quotient(F.col("x"), F.col("l")), F.col("r")).cast("long")
    )
    best = scores.groupBy("lang", "phrase", "n", "a", "total").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    inner = (
        several.where("n >= 3")
        .select("lang", "w", "n", "f", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("m"))
        .select(
            "lang", "w", "f", "m", F.explode(F.sequence(F.lit(1), F.expr("n - m + 1"))).alias("b")
        )
        .select(
            "lang", F.array_join(F.expr("slice(w, b, m)"), " ").alias("phrase"), F.col("f").alias("g")
        )
        .groupBy("lang", "phrase")
        .agg(F.max("g").alias("g"))
    )
    kept = best.join(sized(inner, size), ["lang", "phrase"], "left").where("g is null or g < a")
    return kept.select(
        "lang", "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score"
    )


def quotient(a, b):
    """The floor of a quotient of positive whole decimals: without the rest it is a whole number."""
    b = b.cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def mine(
    docs: DataFrame, least: int = 100, longest: int = 5, bits: int = 32,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All phrases of 2 to ``longest`` words that occur ``least`` times, scored, per language.

    Documents need ``text`` and ``lang``; other columns do not matter. A null text is empty, a null
    language is ``und``; empty texts and an empty table give no phrase; repeated rows count as often
    as they come; long texts are cut where no phrase reaches over. Words of any length are whole.

    Numpy prefix polynomials give the fingerprint of every n-gram of a block at once, and only
    fingerprints, cut to 32 bits, and counts are shuffled: those of all words and pairs of words,
    which grow as the input does, then those of longer n-grams all of whose pairs are frequent. A
    block sends a fingerprint once, so none is hot. A filter of fixed size tells which n-grams are frequent; its errors cost rows
    but never a phrase. At last blocks verify the frequent ones against their text.
    """
    spark = docs.sparkSession
    known = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    rows = stored(blocks(docs, block_bytes), "phrase-blocks", group_bytes=GROUP_BYTES)
    with arrow_rows(spark, BATCH_BLOCKS):
        for lengths in (range(1, min(2, longest) + 1), range(3, longest + 1)):
            if lengths:
                known |= frequent(rows, lengths, known, least, bits)
        counts = stored(materialised(rows, known, least, longest, bits), "phrase-counts")
    words = rows.groupBy("lang").agg(F.sum("n_words").alias("total"))
    return scored(counts, words, longest)


def top(scores: DataFrame, limit: int = 2000) -> DataFrame:
    """The first of each language by score, count and phrase, with their rank from 1."""
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
