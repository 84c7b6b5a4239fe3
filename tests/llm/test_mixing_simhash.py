"""Mixing and SimHash groups against plain forms."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rillhouse.llm import mixing, queries, simhash

ROWS = [
    (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "a b c d e"), (7, "a b c d e"),
    (8, "a b c d f"), (9, "long " * 5000), (None, "a b c d e"), (None, "alone here it is"),
    (None, "alone here it is"), (9, "long " * 5000), (10, "Ä b c"), (11, "ä b c"), (12, "x\xa0y z w"),
]


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, bits=2):
    marks = [plain_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                up[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        have = [x for x in (names.get(find(i)), doc_id) if x is not None]
        names[find(i)] = min(have) if have else None
    return Counter((rows[i][0], f"{marks[i]:016x}", names[find(i)]) for i in range(len(rows)))


def test_fingerprints():
    for _, text in ROWS:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("which", ["odd", "table", "none"])
def test_groups(spark, documents, texts, which):
    rows = {"odd": ROWS, "table": texts, "none": []}[which]
    got = simhash.near_duplicates(documents(rows).withColumnRenamed("lang", "fp")).collect()
    assert Counter((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got) == plain_groups(rows)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_close_pairs_are_all_found(spark, bits):
    base = [0, -1, 0x0123456789ABCDEF]
    marks = set(base)
    for b in base:
        for i in range(0, 64, 3):
            for j in range(i, 64, 7):
                flipped = (b ^ (1 << i) ^ (1 << j)) % (1 << 64)
                marks.add(flipped - (1 << 64) if flipped >> 63 else flipped)
    got = simhash.close_pairs(spark.createDataFrame([(m,) for m in marks], "fp long"), bits).collect()
    want = {(a, b) for a in marks for b in marks if a < b and ((a ^ b) % (1 << 64)).bit_count() <= bits}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_of_each_group_stays(spark, documents):
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_first(documents(ROWS)).collect())
    groups = plain_groups(ROWS)
    want = [g for g in {c for *_, c in groups} if g is not None]
    assert sorted(i for i, _ in kept if i) == sorted(want)
    assert [t for i, t in kept if not i] == ["alone here it is"]


@pytest.mark.parametrize("parts", [1, 4])
def test_rows_of_one_id_are_documents_of_their_own(spark, documents, parts):
    a, b = "alpha beta gamma delta epsilon", "one two three four five six seven"
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (None, "zeta eta theta"), (None, "zeta eta theta")]
    docs = documents(rows).withColumn("text_hash", F.lit(7)).repartition(parts)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_first(docs).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (None, "zeta eta theta")], key=str)


MIX = [
    (1, "a b c", "s1"), (2, "a " * 700, "s2"), (3, None, "s3"), (4, "", "s3"), (5, "x y", None),
    (6, "q " * 40, ""), (None, "no id here", "s1"), (None, None, None), (2, "a " * 700, "s2"),
]


def test_targets_are_shared_as_said(spark):
    rng = [(f"s{k:02d}" if k else None, (k * 7919) % 1000 ** (1 + k % 2)) for k in range(17)]
    got = {
        r.source: r.target
        for r in mixing.source_targets(spark.createDataFrame(rng, "source string, size long")).collect()
    }
    order = sorted(rng, key=lambda r: (r[0] is None, r[0] or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, (s, _) in enumerate(order)}
    sizes = dict(rng)
    target, free = dict.fromkeys(sizes, 0.0), set(sizes)
    rest = 1.5 * sum(sizes.values())
    while free and rest > 1e-9:
        whole = sum(weights[s] for s in free)
        share = {s: target[s] + rest * weights[s] / whole for s in free}
        rest = 0.0
        for s, t in share.items():
            target[s] = min(t, 2.0 * sizes[s])
            rest += t - target[s]
        free = {s for s in free if target[s] < 2.0 * sizes[s]}
    assert got == pytest.approx(target)


def test_mix(spark, documents):
    docs = documents(MIX).withColumnRenamed("lang", "copies")
    got = mixing.mix(docs).collect()
    assert len(got) == len(MIX)
    assert sorted(r.size for r in got) == sorted(
        len((t or "").split()) for _, t, _ in MIX
    )
    for r in got:
        assert r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 2
    again = Counter((r.doc_id, r.source, r.copies) for r in mixing.mix(docs).collect())
    assert again == Counter((r.doc_id, r.source, r.copies) for r in got)
    assert mixing.repeated(mixing.mix(docs)).count() == sum(r.copies for r in got)
    assert mixing.mix(documents([])).count() == 0
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cursor = con.execute(queries.ORACLE["op1_mix_sources"])
    names = [d[0] for d in cursor.description]
    want = Counter(cursor.fetchall())
    got = queries.op1_mix_sources(spark, sf).select(*names).collect()
    assert Counter(tuple(r) for r in got) == want
    taken, target = Counter(), {}
    sources = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect())
    for r in (r.asDict() for r in got):
        taken[sources[r["doc_id"]]] += r["taken"]
        target[sources[r["doc_id"]]] = r["target"]
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.1)
