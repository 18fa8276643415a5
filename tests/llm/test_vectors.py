"""Exact top-k (3) and the pivot index (5) against brute force."""

import math

import numpy as np
import pytest

from deltaq.llm import pivots, topk

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(900, None, 1), (901, [], 1), (902, [1.0, None], 1), (903, [float("nan"), 1.0], 1),
       (904, [float("inf")], 1), (None, [1.0, 2.0], 1), (905, [0.0] * 16, 1)]


def vectors(n=400, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, dim))
    x = base[rng.integers(0, 40, n)] + rng.normal(size=(n, dim)) * rng.choice([0.01, 0.2, 1.0], (n, 1))
    x[50] = x[3]                                           # exact copies
    x[51] = x[3]
    return x.astype(np.float32)


def frame(spark, x, odd=ODD):
    rows = [(i, [float(a) for a in v], 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows + rows[:2] + odd, SCHEMA)     # two rows are repeated


def brute_top(x, k=5, every=50):
    v = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    ids = list(range(len(x))) + [905]
    v = np.vstack([v, np.zeros((1, v.shape[1]), np.int64)])
    out = []
    for i, q in zip(ids, v):
        if i % every == 0:
            best = sorted((-int(q @ c), j) for j, c in zip(ids, v) if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_topk_is_exact(spark, monkeypatch):
    x = vectors()
    assert sorted(map(tuple, topk.op3_topk(frame(spark, x)).collect())) == brute_top(x)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)            # many cells
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 100)
    assert sorted(map(tuple, topk.op3_topk(frame(spark, x)).collect())) == brute_top(x)


def test_topk_with_few_candidates_and_ties(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0], 0), (3, [0.5], 0), (2, [0.5, 0.0], 0)], SCHEMA)
    assert sorted(map(tuple, topk.op3_topk(df).collect())) == [(50, 1, 2, 32768), (50, 2, 3, 32768)]


def test_bound_never_below_the_score():
    rng = np.random.default_rng(2)
    q, c = rng.integers(-300, 300, (5, 24)).astype(float), rng.integers(-300, 300, (900, 24)).astype(float)
    got = list(topk.cell_top(np.arange(5), q, np.arange(100, 1000), c, 5))
    want = [(i, j + 100, int(s)) for i in range(5)
            for s, j in sorted(((q[i] @ c[j], j) for j in range(900)), key=lambda t: (-t[0], t[1]))[:5]]
    assert got == want


def brute_links(x, threshold=0.95):
    u = x.astype(np.float64)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= threshold
    np.fill_diagonal(linked, False)
    component = list(range(len(x)))
    while True:
        new = [min([component[i], *[component[j] for j in np.flatnonzero(linked[i])]])
               for i in range(len(x))]
        if new == component:
            return linked.sum(1), component
        component = new


@pytest.mark.parametrize("block", [1024, 7, 2])
def test_pivot_index_finds_the_links(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "LIST", block)
    x = vectors()
    n_links, component = brute_links(x)
    got = {r.vec_id: r for r in pivots.op5_embedding_dedup(frame(spark, x)).collect()}
    found = sum(got[i].n_links for i in range(len(x)))
    assert found >= 0.98 * n_links.sum()                   # recall; every found link is verified
    assert all(got[i].n_links <= n_links[i] for i in range(len(x)))
    wrong = sum(got[i].component_id != component[i] for i in range(len(x)))
    assert wrong <= 0.02 * len(x)
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(x)))
    for i in (900, 901, 902, 903, 904, 905):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.op3_topk(empty).collect() == []
    assert pivots.op5_embedding_dedup(empty).collect() == []


def test_forest_joins_what_is_linked():
    from deltaq.llm.graph import forest
    child, root = forest(np.array([5, 9, 7]), np.array([3, 5, 8]))
    assert dict(zip(child.tolist(), root.tolist())) == {5: 3, 9: 3, 8: 7}


def test_connected_components_of_a_long_path_and_a_hub(spark):
    from deltaq.llm.graph import connected_components
    path = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(101, 140)]
    got = dict(map(tuple, connected_components(
        spark.createDataFrame(path, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 101 for i in range(101, 140)}, 500: 101}
    assert math.isfinite(len(got))
