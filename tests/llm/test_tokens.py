"""Token counts (1), token files (9) and packing (10) against the tokenizer itself."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from deltaq.llm import packing, token_counts, token_files
from deltaq.llm.encode import Encoder, tokenizer_path

TOKENIZER = Tokenizer.from_file(tokenizer_path())
ENCODER = Encoder(tokenizer_path())
WORDS = ["alpha", "Beta.", "gamma,", "don't", "naïve", "42", "x_y", "ÉTÉ", "–", "日本", "a" * 40]
LONG = " ".join(random.Random(5).choices(WORDS, k=30_000))
ROWS = [(5, "one two three"), (1, None), (2, ""), (9, LONG), (3, "one two three"),
        (4, "<|endoftext|> odd \x1c one"), (7, " ".join(WORDS * 30)), (None, "no id"),
        (6, "tie"), (6, "tie"), (6, "other")]


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(WORDS)), max_size=12))
def test_encoder_equals_the_library(words):
    text = " ".join(words)
    assert list(next(iter(ENCODER.ids([text])))) == ids(text)
    assert list(ENCODER.counts([text])) == [len(ids(text))]


def test_encoder_of_segments_and_a_full_memory(monkeypatch):
    from deltaq.llm import encode
    monkeypatch.setattr(encode, "SEGMENT", 1000)
    monkeypatch.setattr(encode, "MAX_UNITS", 5)
    e = Encoder(tokenizer_path())
    texts = [LONG[:9000], "short", LONG[500:7000]]
    assert [x.tolist() for x in e.ids(texts)] == [ids(t) for t in texts]


def test_histogram_and_suffix_sums(spark, docs):
    lengths = [len(ids(t)) for _, t in ROWS]
    got = {r.length: r for r in token_counts.op1_token_counts(docs(ROWS)).collect()}
    assert sorted(got) == sorted(set(lengths))
    for n, r in got.items():
        assert r.n_docs == lengths.count(n)
        assert r.docs_at_least == sum(x >= n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.tokens_truncated == sum(min(x, n) for x in lengths)
        assert r.cdf == sum(x <= n for x in lengths) / len(lengths)
    sums = token_counts.op1_token_counts(docs(ROWS))
    at = {r.context: r for r in token_counts.at_limits(sums, [4, 100]).collect()}
    assert at[100].tokens_kept == sum(min(x, 100) for x in lengths)
    assert at[4].docs_over == sum(x > 4 for x in lengths)
    assert token_counts.quantiles(sums, [0.5]).first().q500 == sorted(lengths)[
        -(-len(lengths) // 2) - 1]


def test_token_files_round_trip(spark, docs):
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    expected, start = [], 0
    for doc_id, text in order:
        x = ids(text) + [2]
        expected.append((doc_id, len(x), crc(x)))
        start += len(x)
    got = [tuple(r) for r in token_files.op9_token_files(docs(ROWS, "n_tokens")).collect()]
    assert sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in got) == sorted(
        (d is None, d or 0, n, c) for d, n, c in expected)
    at = 0
    for r in sorted(got, key=lambda r: r[1]):           # gapless, in ascending key order
        assert r[1] == at
        at += r[2]
    keys = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert keys == [d for d, _, _ in expected]
    assert at == start


def test_lookup_by_key(spark, docs, scratch):
    rows = [(i * 7, f"text {i} " * (i % 5)) for i in range(3000)]
    files = token_files.write_token_files(docs(rows), scratch + "/files")
    asked = spark.createDataFrame([(7,), (21,), (20993,), (8,)], "doc_id long")
    got = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist()
           for r in token_files.lookup(files, asked).collect()}
    assert got == {k: ids(dict(rows)[k]) + [2] for k in (7, 21, 20993)}   # 8 was never stored


def test_perfect_hash_has_no_holes():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 1000):
        words = (rng.integers(0, 2 ** 63, n).astype(np.uint64), np.zeros(n, np.uint64))
        seeds, slots = token_files.displace(words)
        assert sorted(slots) == list(range(n))
        assert (token_files.slot_of(words, seeds, n) == slots).all()


def check_packing(pieces, texts, window=4096):
    every = {}
    for p in pieces:
        x = (ids(texts[p.doc_id]) + [2])
        assert p.doc_tokens == len(x)
        assert crc(x[p.start:p.start + p.length]) == p.ids_crc32
        every.setdefault(p.doc_id, []).append((p.start, p.length))
    for doc_id, cuts in every.items():
        at = 0
        for start, length in sorted(cuts):
            assert start == at and length > 0
            at += length
        assert at == len(ids(texts[doc_id])) + 1
    assert set(every) == set(texts)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for cuts in sequences.values():
        at = 0
        for offset, length in sorted(cuts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


def test_packing_places_every_id_once(spark, docs):
    rows = [r for r in ROWS if r[0] not in (6, None)]
    pieces = packing.op10_packing(docs(rows, "offset")).collect()
    check_packing(pieces, dict(rows))


def test_packing_of_many_tasks_leaves_little_padding(spark, docs):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 900)))) for i in range(300)]
    table = docs(rows).repartition(40)                    # more tasks than one merge takes
    pieces = packing.op10_packing(table).collect()
    n = check_packing(pieces, dict(rows))
    tokens = sum(len(ids(t)) + 1 for _, t in rows)
    assert tokens / (n * 4096) > 0.97


def test_repeated_rows_and_null_ids_are_packed_each(spark, docs):
    pieces = packing.op10_packing(docs([(6, "tie"), (6, "tie"), (None, None)])).collect()
    assert sorted((p.doc_id or 0, p.length) for p in pieces) == sorted(
        [(0, 1), (6, len(ids("tie")) + 1), (6, len(ids("tie")) + 1)])


@pytest.mark.parametrize("operator", [token_counts.op1_token_counts, token_files.op9_token_files,
                                      packing.op10_packing])
def test_empty_table(spark, docs, operator):
    assert operator(docs([])).collect() == []
