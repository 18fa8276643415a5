"""Pareto order sampling (7): targets, closeness, reruns, unequal probabilities."""

import random

import pytest
from pyspark.sql import functions as F

from deltaq.llm import mixing


def brute_targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            free.discard(s)
    return target


def corpus(seed=0, n=600):
    rng = random.Random(seed)
    source = lambda: rng.choices(["hot", "b", "c", "é", None, "tiny"], [9, 3, 3, 2, 2, 0.2])[0]
    return [(i, " ".join(["w"] * rng.randint(0, 120)), source()) for i in range(n)]


def test_targets_and_closeness(spark, docs):
    rows = corpus() + [(9001, None, "hot"), (9002, "", "empty"), (None, "a b c", "hot"),
                       (5000, "x " * 300, "hot"), (5000, "x " * 300, "hot")]
    got = mixing.op7_mixing(docs(rows, "target")).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute_targets(sizes)
    by = {}
    key = {i: s for i, _, s in rows}
    for r in got:
        s = key[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by[s] = by.get(s, 0) + r.taken
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s in by:
        assert abs(by[s] - target[s]) <= max(60, 0.01 * target[s])
    assert sorted(map(str, got)) == sorted(map(str, mixing.op7_mixing(
        docs(rows).repartition(7)).collect()))


def test_mixed_documents_repeat_whole_rows(spark, docs):
    rows = corpus(2, 200)
    table = docs(rows, "copies")
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns
    want = {r.doc_id: r.taken // r.size if r.size else None
            for r in mixing.op7_mixing(table).collect()}
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(got.get(i, 0) == n for i, n in want.items() if n is not None)


def test_repeated_rows_at_the_cut(spark, docs):
    rows = [(1, "a b c d", "s")] * 50 + [(2, "a", "t")]
    got = mixing.op7_mixing(docs(rows)).collect()
    for size, source in ((200, "s"), (1, "t")):
        mine = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 4


def test_unequal_probabilities(spark):
    """Documents with a higher expected number of copies are taken more often."""
    n, runs = 400, 30
    rows = spark.range(n).selectExpr("id AS doc_id", "'s' AS source", "cast(1 as long) AS size",
                                     "if(id % 2 = 0, 0.2D, 0.7D) AS expected")
    taken = [0, 0]
    for k in range(runs):
        part = F.col("expected") - F.floor("expected")
        u = mixing.uniform(F.col("doc_id"), F.lit("d"), f"seed{k}")
        keyed = rows.withColumn("order_key", mixing._order(mixing._rank(u, part), F.col("doc_id"),
                                                           F.lit("d")))
        cut = mixing.pareto_cut(keyed).first()
        below = keyed.filter(F.col("order_key.rank") <= cut.cut.rank)
        for parity, c in below.groupBy((F.col("doc_id") % 2).alias("p")).count().collect():
            taken[parity] += c
    assert sum(taken) == runs * n * 0.45                   # fixed size
    assert taken[0] / (runs * n / 2) == pytest.approx(0.2, abs=0.03)
    assert taken[1] / (runs * n / 2) == pytest.approx(0.7, abs=0.03)


def test_empty_table(spark, docs):
    assert mixing.op7_mixing(docs([])).collect() == []
    assert mixing.mixed_documents(docs([])).collect() == []
