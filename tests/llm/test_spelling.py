"""Near words against brute force over all pairs; counts, forms and roots of the whole query."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from deltaq.llm import spelling
from deltaq.llm.common import table
from deltaq.llm.queries import QUERIES

TESTS = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(docs):
    seen = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{word}".encode())
                if h % 97 == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
            seen[word] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def brute_forms(counts):
    words = sorted(counts)
    links = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if abs(len(a) - len(b)) < 2 and near(a, b):
                links[a].append(b)
                links[b].append(a)
    form = {}
    for w in words:
        best = min(links[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(links[w]), counts[form[w]] if form[w] else None))
    return out


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def vocabulary(size, letters, longest, seed):
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list(letters), int(rng.integers(1, longest))))
             for _ in range(size)}
    for w in list(words)[:size // 2]:       # neighbours
        i = int(rng.integers(0, len(w)))
        words |= {w[:i] + w[i + 1:], w[:i] + rng.choice(list(letters)) + w[i + 1:],
                  w[:i] + rng.choice(list(letters)) + w[i:]}
    return sorted(words - {""})


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_near_words_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TOGETHER", min(block, 160))
    words = vocabulary(150, "abe", 8, 1) + ["x" * 40 + y for y in ("", "x", "y", "z")]
    words += ["é" * 3, "éé", "éëé", "÷×÷", "ÀÀÀ", "ààà"] + ["a" * 3000, "a" * 3001, "a" * 2999 + "b"]
    words = sorted(set(words))
    got = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    want = {(a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and near(a, b)}
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want


def test_products_give_squared_distances():
    words = vocabulary(60, "abcxyzéß", 9, 2)
    counts = spelling._letter_counts(words)
    got = -2 * spelling.squared_distances(counts[:40], counts[20:])
    assert got.tolist() == [[sum((a - b) ** 2 for a, b in zip(x, y)) for y in counts[20:].tolist()]
                            for x in counts[:40].tolist()]


def test_one_edit_and_its_vectorised_form():
    words = vocabulary(60, "abc", 6, 3)
    pairs = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words)
             if len(a) <= len(b) <= len(a) + 1]
    want = [near(words[i], words[j]) for i, j in pairs]
    assert [spelling.one_edit(words[i], words[j]) for i, j in pairs] == want
    i, j = np.array(pairs).T
    for letters in (spelling._letters(words), None):
        assert spelling._verified(words, letters, i, j).tolist() == want


def test_planted_typos_follow_the_checksum():
    words = spelling.Words()
    for doc_id in range(300):
        own = ["alpha", "béta", "gamma", "a", "déjà", "épsilon" * 9]
        numbers = np.array([words[w] for w in own])
        want = []
        for at, w in enumerate(own):
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 97 == 0:
                want.append((at, w[:h % len(w)] + w[h % len(w) + 1:]))
        assert list(spelling.planted_typos(doc_id, words, numbers)) == want


def test_query_on_fixture(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MAX_WORDS", 40)       # tasks hand on their counts many times
    rng = np.random.default_rng(5)
    words = vocabulary(80, "abcdé", 9, 4)
    docs = [(i, " ".join(rng.choice(words, 60)) + " Alpha ALPHA alphas alphaz?alphà1alpha")
            for i in range(40)]
    docs += [(None, "alpha " * 5), (None, None), (40, None), (41, ""), (42, "12 ,. 日本語 日本語"),
             (43, ("q" * 5000 + " ") * 3 + ("q" * 5001 + "-") * 7), (44, "ÀÉÎÕÜ àéîõü " * 4),
             (45, "chain " * 3 + "chains " * 6 + "chainss " * 12 + "chainsss " * 24), (45, "tie" * 3)]
    docs += docs[:5]
    df = spark.createDataFrame([(i, t, "clash", 2, 1.5) for i, t in docs],
                               "doc_id long, text string, word string, n int, b double")
    want = brute_forms(brute_counts(docs))
    assert any(w[2] != w[1] and w[1] for w in want)
    assert rows(spelling.op12_spelling_groups(df)) == sorted(want)


def test_empty_tables_and_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rows(spelling.op12_spelling_groups(empty)) == []
    none = spark.createDataFrame([(1, None), (2, "a bc")], "doc_id long, text string")
    assert rows(spelling.op12_spelling_groups(none)) == []


def test_registered_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in table(spark, TESTS, "documents").select("doc_id", "text").collect()]
    want = brute_forms(brute_counts(docs))
    assert len(want) > 500
    assert rows(QUERIES["op12_spelling_groups"](spark, TESTS)) == sorted(want)
