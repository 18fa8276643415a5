"""Chosen-path near-duplicates (6) against all pairs of full sets."""

import random

import pytest
from pyspark.sql import functions as F

from deltaq.llm import near_dups
from deltaq.llm.graph import with_cells


def words_of(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words_of(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, percent=85):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    component = {i: i for i in sets}

    def root(x):
        while component[x] != x:
            x = component[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = root(i), root(j)
                component[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=1, groups=12, large=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, passage = [], rng.choices(vocabulary, k=60)
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([8, 60, 150]))
        for _ in range(large if g == 0 else rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    rows += [" ".join(passage + rng.choices(vocabulary, k=40)) for _ in range(40)]   # shared passage
    rng.shuffle(rows)
    rows += [None, "", "  \n", "One two", "one TWO", "one two three", rows[0].upper(),
             " ".join(rng.choices(vocabulary, k=20_000))]
    return list(enumerate(rows))


@pytest.mark.parametrize("small,segment", [(256, 1 << 22), (8, 500)])
def test_components_equal_all_pairs(spark, docs, monkeypatch, small, segment):
    monkeypatch.setattr(near_dups, "SMALL", small)         # many levels and blocks
    monkeypatch.setattr(near_dups, "SEGMENT", segment)
    rows = corpus()
    got = {r.doc_id: r for r in near_dups.op6_minhash_dedup(docs(rows, "component_id")).collect()}
    want = brute(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_null_ids_and_repeated_rows(spark, docs):
    text = "a b c d e f g h i j"
    rows = [(None, text), (4, text), (4, text), (2, text), (9, "something else entirely here now")]
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in
                  near_dups.op6_minhash_dedup(docs(rows)).collect()), key=str)
    assert got == sorted([(0, None, True), (4, 2, False), (4, 2, False), (2, 2, True),
                          (9, 9, True)], key=str)


def test_filter_keeps_one_row_of_a_group(spark, docs):
    text = "a b c d e f g h i j"
    # The sets of 1 and 2 share 6 of 7 shingles (0.857), those of 2 and 4 share 7 of 8 (0.875).
    rows = [(3, text), (1, text), (1, text), (2, text + " k"), (4, text + " k l"), (5, "x"),
            (None, text)]
    kept = near_dups.without_near_duplicates(docs(rows, "kept"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        [(0, text), (1, text), (5, "x")])


def test_filter_leaves_apart_what_is_less_alike(spark, docs):
    text = "a b c d e f g h i j"
    rows = [(1, text), (4, text + " k l")]
    kept = near_dups.without_near_duplicates(docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_dense_groups_are_not_branched(spark, docs, monkeypatch):
    """One group larger than a block, of near copies: a leaf at once, with the same components."""
    monkeypatch.setattr(near_dups, "SMALL", 16)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        w = list(base)
        w[rng.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(rng.choices(base, k=60))) for i in range(30)]
    table = docs(rows)
    described = near_dups.materialize(near_dups.describe(table), "t").filter("key is not null")
    reps = described.selectExpr("doc_id as rep", "tokens")
    at = near_dups.Threshold(85)
    paths = near_dups._sized(reps.mapInArrow(
        lambda parts: near_dups._branch(parts, True, at), "node long, rep long"))
    large = near_dups.materialize(paths.filter("size > 16"), "t")
    dense = {r.node for r in near_dups.dense_nodes(large, reps, at).collect()}
    assert dense == {r.node for r in large.collect()} and dense
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dups.op6_minhash_dedup(table).collect()}
    assert got == brute(rows)


def _edged_group(n=120):
    """Near copies of one text, each a block of words off, and documents that share half of it:
    these have the smallest ids, so a tree node's first document is like few of it."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[:260] + [f"y{i}x{j}" for j in range(140)])) for i in range(20)]
    for i in range(20, n):
        w = list(base)
        w[rng.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(w)))
    return rows


def _first_level(docs, rows, at):
    described = near_dups.materialize(near_dups.describe(docs(rows)), "t")
    reps = described.selectExpr("doc_id as rep", "tokens")
    paths = near_dups._sized(reps.mapInArrow(
        lambda parts: near_dups._branch(parts, True, at), "node long, rep long"))
    return reps, near_dups.materialize(paths.filter("size > 16"), "t")


def test_a_group_is_dense_whatever_its_first_document(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dups, "SMALL", 16)
    rows, at = _edged_group(), near_dups.Threshold(80)
    reps, large = _first_level(docs, rows, at)
    edged = {r.node for r in large.filter("first < 20 and size > 60").collect()}
    dense = {r.node for r in near_dups.dense_nodes(large, reps, at).collect()}
    assert edged and edged <= dense
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dups.near_duplicates(docs(rows), 80).collect()}
    assert got == brute(rows, 80)


def test_a_dense_group_is_compared_once_and_not_once_a_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dups, "SMALL", 16)
    rows, at = _edged_group(), near_dups.Threshold(80)
    reps, _ = _first_level(docs, rows, at)
    leaves = near_dups.materialize(near_dups.chosen_paths(reps, at), "t")
    of_group = leaves.filter("rep >= 20 and size > 16").groupBy("rep").count()
    assert [r["count"] for r in of_group.collect()] == [1] * 100
    assert leaves.filter("size > 16 and rep = first").count() == 1


@pytest.mark.parametrize("n,united", [(40, 30), (40, 39), (40, 1), (7, 5)])
def test_cells_leave_out_only_pairs_that_are_united(spark, n, united):
    rows = spark.range(n).selectExpr("id", f"id < {united} as u").selectExpr(
        "*", f"{n} as size", f"{united} as m")
    cells = with_cells(rows, F.col("size"), F.col("id"), 8, F.col("u"), F.col("m"))
    met, held = set(), {}
    for r in cells.collect():
        held.setdefault((r._i, r._j), []).append(r)
    for (i, j), cell in held.items():
        met |= {frozenset((a.id, b.id)) for a in cell for b in cell
                if (a._b, b._b) == (i, j) and a.id != b.id}
    want = {frozenset((a, b)) for a in range(n) for b in range(a)}
    apart = {p for p in want if not max(p) < united}
    assert apart <= met and (met == want if n <= 8 else met == apart)
    plain = with_cells(rows, F.col("size"), F.col("id"), 8).count()
    assert cells.count() < plain or n <= 8 or united == 1


def test_empty_table(spark, docs):
    assert near_dups.op6_minhash_dedup(docs([])).collect() == []
    assert near_dups.without_near_duplicates(docs([])).collect() == []


def test_common_counts_all_pairs():
    import numpy as np
    rng = np.random.default_rng(3)
    values = [np.unique(rng.integers(0, 50, rng.integers(0, 30)).astype(np.uint64)) for _ in range(9)]
    left, right = np.arange(5), np.arange(3, 9)
    got = near_dups._common(values, left, right)
    assert got.tolist() == [[len(set(values[i]) & set(values[j])) for j in right] for i in left]


def components_from(rows, percent):
    """Smallest ids of the groups that links from ``percent`` per cent on make, by all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and common and 100 * common >= percent * len(sets[i] | sets[j]):
                x, y = sorted((label[i], label[j]))
                label = {k: x if v == y else v for k, v in label.items()}
    return label


def copies_around_80(seed=4):
    """Texts of 105 words with copies of which 1 to 3 words far from each other are new: of 101
    shingles 96, 91 or 86 stay, similarities 0.91, 0.82 and 0.74."""
    rng = random.Random(seed)
    rows = []
    for g in range(15):
        base = [f"b{g}x{i}" for i in range(105)]
        for n in (0, 1 + g % 3):
            w = list(base)
            for k in range(n):
                w[20 + 30 * k] = f"new{rng.random()}"
            rows.append(" ".join(w))
    return list(enumerate(rows))


def test_threshold_is_a_parameter_and_the_stage_takes_80(spark, docs):
    import corpus_pipeline
    rows = copies_around_80()
    at = {p: components_from(rows, p) for p in (80, 85)}
    assert at[80] != at[85]
    for percent, want in at.items():
        got = near_dups.near_duplicates(docs(rows), percent).collect()
        assert {r.doc_id: r.component_id for r in got} == want
    kept = {r.doc_id for r in corpus_pipeline.dedup_stage(spark, docs(rows), "").collect()}
    assert kept == {i for i, c in at[80].items() if i == c}


def test_settings_follow_the_threshold():
    at85, at80 = near_dups.Threshold(85), near_dups.Threshold(80)
    assert (at85.agree, at85.trees, at80.agree, at80.trees) == (93, 10, 85, 12)
    assert at80.second == 0.25


def test_an_id_repeated_with_other_texts_loses_none(spark, docs):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(20))

    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (5, text("c")), (5, text("c")),
            (7, text("c")), (8, text("b").upper()), (5, text("e")), (5, text("e") + " more"),
            (6, text("d")), (None, text("n")), (None, text("n")), (None, text("n") + " more"),
            (None, text("a"))]
    got = near_dups.without_near_duplicates(docs(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id and "e1" not in r.text) == [
        (1, text("a")), (5, text("b")), (5, text("c")), (6, text("d"))]
    assert len([r for r in got if "e1" in r.text.split()]) == 1      # near copies under one id
    none = sorted(r.text for r in got if r.doc_id is None)
    assert none[0] == text("a") and len(none) == 2 and none[1].startswith(text("n"))
