"""Tokens, packing and token files against the plain use of the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rillhouse.llm import packing, queries, token_files
from rillhouse.llm.tokens import SPACE, Encoder, encoder

BYTES, WORDS = (queries.vocabulary(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PLAIN = {f: Tokenizer.from_file(f) for f in (BYTES, WORDS)}
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b\n\n c\t"), (5, "x" * 3000), (6, "the cat sat " * 2000),
    (7, "the cat sat " * 2000), (8, "\x00 nul \x00\x00 here\x00"), (9, "Ünïcödé 漢字 　 🙂 don't"),
    (10, "<|endoftext|> in text <|startoftext|>"), (None, "no id"), (None, "no id"), (1, "again"),
]


def plain_ids(path, text):
    return PLAIN[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,spaces", [(BYTES, True), (WORDS, False)])
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(SPACE + "ab'sΣ!\x00\x1c"))))
def test_chunks_give_the_library_s_ids(path, spaces, text):
    assert encoder(path, spaces).encode(text).tolist() == plain_ids(path, text)


def test_memory_of_chunks_may_be_cleared(monkeypatch):
    monkeypatch.setattr("rillhouse.llm.tokens.MEMORY", 3)
    one = Encoder(BYTES, True)
    for text in ("a b c d e f", "f e d c", "a x y z a"):
        assert one.encode(text).tolist() == plain_ids(BYTES, text)


def check_runs(counts, runs, capacity):
    """Every rank of every length has its own place; returns the sequences' fillings."""
    filled = defaultdict(list)
    for size, n in counts.items():
        marks = [r[0] for r in runs.get(size, [])] + [n]
        assert marks[0] == 0
        for (rank, sequence, per, offset), end in zip(runs[size], marks[1:], strict=True):
            for k in range(end - rank):
                filled[sequence + k // per].append((offset + k % per * size, size))
    for spans in filled.values():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end <= capacity
    return filled


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40)))
def test_plan_places_every_piece_once_without_gaps(counts):
    filled = check_runs(counts, packing.plan(counts, 60), 60)
    assert sum(map(len, filled.values())) == sum(counts.values())
    large = [sum(3 * s > 60 for _, s in spans) for spans in filled.values()]
    assert not large or max(large) <= 2


def test_plan_comes_near_the_least_number():
    rng = random.Random(5)
    counts = Counter(min(1024, int(rng.paretovariate(0.7) * 30)) for _ in range(20_000))
    filled = check_runs(counts, packing.plan(counts), 1024)
    least = -(-sum(k * n for k, n in counts.items()) // 1024)
    assert len(filled) <= least * 1.01 + 1


def expected_pieces(rows):
    out = []
    for doc_id, text in rows:
        ids = [*plain_ids(BYTES, text), 2]
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            out.append((doc_id, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["odd", "table", "none"])
def test_packing(spark, documents, texts, which):
    rows = {"odd": ODD, "table": texts, "none": []}[which]
    docs = documents(rows).withColumnRenamed("lang", "ids")
    packed = packing.pack(docs, BYTES)
    got = packed.collect()
    assert sorted((tuple(r)[:4] + (bytes(r.ids),) for r in got), key=str) == expected_pieces(rows)
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for held in spans.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    again = {(r.doc_id, r.piece, r.start): (r.sequence_id, r.offset) for r in got if r.doc_id}
    assert again == {
        (r.doc_id, r.piece, r.start): (r.sequence_id, r.offset)
        for r in packing.pack(docs, BYTES).collect() if r.doc_id
    } or which == "odd"
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert all(joined[r.sequence_id][4 * r.offset:][:4 * r.length] == bytes(r.ids) for r in got)


@pytest.mark.parametrize("which", ["odd", "table", "none"])
def test_token_files_round_trip(spark, documents, texts, which, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_CHARS", 20_000)
    rows = {"odd": ODD, "table": texts, "none": []}[which]
    written = token_files.write(documents(rows), WORDS)
    got = sorted(token_files.read(written).collect(), key=lambda r: r.start)
    want = Counter((i, (*plain_ids(WORDS, t), 1)) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert [r.doc_id or -1 for r in got] == sorted(i or -1 for i, _ in rows)
    begin = 0
    for r in got:
        assert r.start == begin
        begin += len(r.ids) // 4
    if which == "table":
        assert written.manifest().count() > 3
        one = written.manifest().orderBy("part").first()
        reader = token_files.Reader(f"{written.folder}/{one.file}", written.dictionary)
        assert reader.ids(3).tolist() == [*plain_ids(WORDS, sorted(rows)[3][1]), 1]
        with pytest.raises(ValueError, match="dictionary"):
            token_files.Reader(f"{written.folder}/{one.file}", written.dictionary + b"x")


def test_queries(spark, sf, texts):
    got = {(r.doc_id, r.piece): r for r in queries.op5_pack_best_fit(spark, sf).collect()}
    for doc_id, piece, start, length, ids in expected_pieces(texts):
        r = got.pop((doc_id, piece))
        assert (r.start, r.length, r.ids_crc32) == (start, length, zlib.crc32(ids))
    assert not got
    start = 0
    found = {r.doc_id: r for r in queries.op10_token_files(spark, sf).collect()}
    for doc_id, text in sorted(texts):
        ids = np.array([*plain_ids(WORDS, text), 1], "<u4")
        r = found[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_another_vocabulary_goes_to_the_library_whole(tmp_path, name, spaces):
    import json

    from tokenizers import Tokenizer

    from rillhouse.llm.queries import vocabulary
    from rillhouse.llm.tokens import Encoder, known

    assert known(vocabulary(name), spaces)
    assert not known(vocabulary(name), not spaces)
    says = json.loads(open(vocabulary(name), encoding="utf-8").read())
    says["normalizer"] = {"type": "Replace", "pattern": {"String": "a"}, "content": "b"}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(says))
    text = "a banana  and\n it's Ünïcode"
    plain = Tokenizer.from_file(str(other)).encode(text, add_special_tokens=False).ids
    assert not known(str(other), spaces) and Encoder(str(other), spaces).encode(text).tolist() == plain
