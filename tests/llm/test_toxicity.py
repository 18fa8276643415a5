"""Ordinal regression (2): held-out accuracy, order of the thresholds, edge cases."""

import random

import numpy as np
import pytest

from deltaq.llm import toxicity

CLEAN = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
BAD = ["gromling", "snorbic", "vilethan", "plunder"]


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        toxic = rng.random() < 0.2
        w = rng.choices(CLEAN, k=rng.randint(5, 80))
        if toxic:
            for _ in range(rng.randint(1, 6)):
                bad = rng.choice(BAD)
                w.insert(rng.randrange(len(w)), bad if rng.random() < 0.5 else bad + rng.choice(CLEAN))
        out.append((i, " ".join(w), int(toxic)))
    return out


@pytest.fixture(scope="module")
def labelled():
    return texts(1500, 1)


def label_table(spark, rows, extra=()):
    return spark.createDataFrame([(i, t) for i, _, t in rows] + list(extra), "doc_id long, toxic int")


def test_held_out_accuracy_and_severity(spark, docs, labelled):
    train, held = labelled[:1000], labelled[1000:]
    model = toxicity.fit(docs([(i, t) for i, t, _ in train]),
                         label_table(spark, train, [(None, 1), (3, None), (99999, 1)]))
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == toxicity.GRADES
    got = {r.doc_id: r for r in toxicity.grade(docs([(i, t) for i, t, _ in held], "grade"), model)
           .collect()}
    wrong = sum(got[i].toxic != bool(y) for i, _, y in held)
    assert wrong <= 0.02 * len(held)
    for r in got.values():
        assert 0 <= r.severity <= toxicity.GRADES and r.toxic == (r.p_toxic >= 0.5)
    hits = {i: sum(b in w for b in BAD for w in t.split()) for i, t, _ in held}
    mean = lambda ids: np.mean([got[i].severity for i in ids])
    some, many = [i for i, n in hits.items() if n == 1], [i for i, n in hits.items() if n >= 4]
    assert mean([i for i, n in hits.items() if n == 0]) < 0.1 < mean(some) < mean(many)


def test_given_grades_are_used_and_the_sample_is_bounded(spark, docs, labelled):
    rows = labelled[:600]
    graded = spark.createDataFrame([(i, 2 * y) for i, _, y in rows], "doc_id long, grade int")
    model = toxicity.fit(docs([(i, t) for i, t, _ in rows]), graded, most=300)
    assert len(model.thresholds) == 2
    assert toxicity.sample_labels(graded, 300).count() == 300
    one = toxicity.grade(docs([(1, " ".join(BAD * 3))]), model).first()
    assert one.severity > 1.5 and one.grade == 2


def test_copies_count_once():
    import pyarrow as pa
    b, n = np.array([1, 2], np.int32).tobytes(), np.array([1, 1], np.int32).tobytes()
    rows = pa.table({"y": pa.array([1, 0, 0], pa.int32()), "bins": [b, n[:4], n[:4]],
                     "counts": [n, n[:4], n[:4]], "marks": [1.0, 0.0, 0.0]})
    assert len(toxicity.fit_rows(rows, graded=False).thresholds) == toxicity.GRADES


def test_edge_texts(spark, docs, labelled):
    model = toxicity.fit(docs([(i, t) for i, t, _ in labelled]), label_table(spark, labelled))
    rows = [(1, None), (2, ""), (3, "wordaa " * 50_000), (4, "gromling " * 20_000), (None, "wordaa"),
            (5, "wordaa"), (5, "wordaa")]
    got = toxicity.grade(docs(rows), model).collect()
    assert len(got) == 7
    assert [r.doc_id for r in got if r.toxic] == [4]
    kept = toxicity.without_toxic(docs(rows, "toxic"), model)
    assert kept.columns[-1] == "toxic" and kept.count() == 6


def test_without_labels_of_both_kinds_nothing_is_toxic(spark, docs, labelled):
    rows = docs([(i, t) for i, t, _ in labelled[:50]])
    for labels in (label_table(spark, []), label_table(spark, [(1, "", 0)])):
        model = toxicity.fit(rows, labels)
        assert not any(r.toxic for r in toxicity.grade(rows, model).collect())
    model = toxicity.fit(docs([]), label_table(spark, labelled))
    assert toxicity.grade(docs([]), model).collect() == []
