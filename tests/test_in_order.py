"""Batches that come in order look only at what they delete; the round's parts come from a sample."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from deltaq.sources import changelog as C
from deltaq.streaming import normalise as N

ROWS = [(1, "INSERT", 1, 0), (2, "DELETE", 1, 0), (3, "INSERT", 1, 0), (4, "INSERT", 2, 0),
        (5, "INSERT", 2, 0), (11, "INSERT", 2, 1), (12, "INSERT", 3, 1), (13, "INSERT", None, 1),
        (21, "DELETE", 2, 2), (22, "INSERT", 2, 2), (23, "DELETE", 9, 2), (24, "DELETE", None, 2),
        (31, "INSERT", 1, 3), (32, "INSERT", 2, 3), (41, "DELETE", 1, 4), (42, "DELETE", 3, 4)]


@pytest.mark.parametrize("ahead", [True, False])
@pytest.mark.parametrize("every", [1, 2, 8])
def test_batches_in_order_have_the_same_net_changes(spark, scratch, every, ahead):
    df = spark.createDataFrame(ROWS, "seq bigint, op string, k bigint, b int")
    got = {}
    for in_order in (False, True):
        log = os.path.join(scratch, str(in_order))
        got[in_order] = [sorted((r.seq, r.k, r.w) for r in N.normalise(
            spark, lambda wanted: df.filter(F.col("b").isin(wanted)), b, log, ["k"], every=every,
            ahead=ahead, in_order=in_order).collect()) for b in range(5)]
    assert got[True] == got[False]
    assert got[True][2] == [(4, 2, -1), (5, 2, -1), (11, 2, -1), (22, 2, 1)]


def test_a_batch_without_deletes_reads_no_earlier_rows(spark, scratch, monkeypatch):
    steps = []

    def step(df, log_path, name, old=N._step):
        steps.append(name)
        return old(df, log_path, name)
    monkeypatch.setattr(N, "_step", step)
    df = spark.createDataFrame(ROWS, "seq bigint, op string, k bigint, b int")
    for b in (0, 1):
        steps.clear()
        rows = N.normalise(spark, lambda wanted: df.filter(F.col("b").isin(wanted)), b, scratch,
                           ["k"], in_order=True)
        assert sorted(r.seq for r in rows.collect()) == [[3, 4, 5], [11, 12, 13]][b]
    assert steps == ["touched_keys"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("kind", ["even", "hot", "few", "nulls"])
def test_parts_from_a_sample_keep_the_order(spark, scratch, kind):
    """Part numbers follow the order with a sample, also where it is too small or uneven to use."""
    n = 20_000
    seq = {"even": F.col("id") * 7919 % n, "few": F.col("id") * 7919 % n,
           "hot": F.when(F.col("id") < n // 2, F.col("id")).otherwise(F.lit(10 ** 12) + F.col("id")),
           "nulls": F.when(F.col("id") % 100 > 0, F.col("id") * 7919 % n)}[kind]
    changes = spark.range(n).select(seq.alias("seq"), F.concat(F.lit("line "), F.coalesce(
        seq, F.lit(-1))).alias("line"))
    sample = changes.sample(0.5 if kind != "few" else 0.001, seed=1)
    used = C._part_of("seq", sample, 8) is not None
    assert used == (kind in ("even", "nulls"))
    path = os.path.join(scratch, "text")
    C.write_changelog(changes, path, partitions=8, sample=sample)
    assert len(glob.glob(os.path.join(path, "part-*"))) == 8
    read = [int(r["value"][5:]) for r in C.read_changelog(spark, path).orderBy("seq").collect()]
    assert len(read) == n and read == sorted(read)
