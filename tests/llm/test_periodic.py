"""Runs of words against brute force, fed whole and in small slabs; edge cases of the query."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from deltaq.llm import periodic
from deltaq.llm.common import table
from deltaq.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TESTS = "/root/testdata/sf0.001"


def brute(x, least=24, times=3):
    """(start, length, period): per period, stretches of words that come again a period later."""
    n, found = len(x), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            if i + q - s >= max(least, times * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def expected(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words)
            if not any(s + q <= i < s + length for s, length, q in runs)]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3),
            1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(kept)))


def rows(df):
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                          "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sequences():
    rng = np.random.default_rng(11)
    for k in range(250):
        size = int(rng.integers(0, 160))
        x = rng.integers(0, int(rng.integers(1, 5)), size)
        for _ in range(int(rng.integers(0, 4))):       # repeat stretches, one inside another
            if size > 6:
                a = int(rng.integers(0, size - 5))
                b = int(rng.integers(a + 4, size))
                q = int(rng.integers(1, max(2, (b - a) // 3 + 2)))
                x[a:b] = np.resize(x[a:a + q], b - a)
        yield x
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 33):
        yield np.resize(rng.integers(0, 9, q), 3 * q + 40)
        yield np.concatenate([rng.integers(50, 90, 5), np.resize(np.arange(q), 3 * q), [99]])
        yield np.concatenate([rng.integers(50, 90, 5), np.resize(np.arange(q), 3 * q - 1), [99]])


@pytest.mark.parametrize("slab", [1, 7, 64, 1 << 16])
def test_catcher_matches_brute_force(slab, monkeypatch):
    monkeypatch.setattr(periodic, "SLAB", slab)
    for x in sequences():
        if slab == 1 and len(x) > 90:
            continue
        for least, times in ((24, 3), (3, 3), (10, 4)):
            catcher = periodic.SquareCatcher(least, times)
            catcher.append(x)
            got = [(s, e - s, q) for s, e, q in catcher.runs()]
            assert got == brute(x.tolist(), least, times), (x.tolist(), least, times)


def test_many_texts_share_a_catcher():
    texts = list(sequences())
    assert periodic.runs_of_texts(texts) == [brute(x.tolist()) for x in texts]


def test_colliding_fingerprints_change_nothing(monkeypatch):
    real = periodic._mixed
    monkeypatch.setattr(periodic, "_mixed", lambda a, b: real(a, b) & np.uint64(3))
    for x in list(sequences())[:80]:
        assert periodic.runs_of_texts([x]) == [brute(x.tolist())]


def test_long_text_of_one_word_and_thue_morse():
    n = 150_000
    assert periodic.runs_of_texts([np.zeros(n, np.int64)]) == [[(0, n, 1)]]
    assert periodic.runs_of_texts([np.resize(np.arange(1000), n)]) == [[(0, n, 1000)]]
    morse = np.array([bin(i).count("1") % 2 for i in range(1 << 13)])   # free of cubes
    assert periodic.runs_of_texts([morse], least=3) == [[]]


def test_query_on_fixture(spark):
    a, b = "x y z " * 30, "one two three four five six seven eight nine ten " * 4
    texts = [(1, a), (2, b), (3, a + b + a), (3, a + b + a), (4, None), (5, ""), (6, " \t\n"),
             (None, a), (None, None), (7, "a b c d " * 20), (8, "é" * 5), (9, "w " * 23),
             (10, "w " * 24), (11, "p q " * 9000 + "tail"), (12, " ".join(map(str, range(300))))]
    texts += [(i, " ".join(str(j % (i % 37 + 2)) for j in range(i * 3 % 211))) for i in range(20, 140)]
    docs = spark.createDataFrame(
        [(i, t, "clash", 1, [2]) for i, t in texts],
        "doc_id long, text string, runs string, start long, length array<int>")
    assert rows(periodic.op11_periodic_runs(docs)) == sorted(
        (expected(i, t) for i, t in texts), key=repr)


def test_query_on_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rows(periodic.op11_periodic_runs(docs)) == []


def test_operator_returns_texts_and_spans(spark):
    docs = spark.createDataFrame([(1, "a b " + "c d e " * 10 + "f")], "doc_id long, text string")
    row = periodic.periodic_runs(docs).first()
    assert row.collapsed == "a b c d e f" and row.n_words == 33
    assert [tuple(r) for r in row.runs] == [(2, 30, 3)]


def test_registered_query_over_the_whole_table(spark):
    docs = table(spark, TESTS, "documents").select("doc_id", "text").collect()
    short = [r for r in docs if len(r.text or "") < 4000]
    want = {r.doc_id: expected(r.doc_id, r.text) for r in short}
    got = {r[0]: r for r in rows(QUERIES["op11_periodic_runs"](spark, TESTS))}
    assert len(got) == len(docs)
    assert {i: got[i] for i in want} == want
