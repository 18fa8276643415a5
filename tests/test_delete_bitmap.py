"""Joins to the last deletes behind a bitmap of their keys: the same rows, most of them unmoved."""

import os

import pytest
from pyspark.sql import functions as F

from deltaq.operators import replay as R
from deltaq.operators import synth as S
from deltaq.streaming.normalise import normalise

from .test_replay_ops import changes, expected_live


@pytest.fixture
def bitmaps(monkeypatch):
    """Any number of keys has a bitmap; how many were made."""
    made = []
    real = R.key_bitmap
    monkeypatch.setattr(R, "FILTER_FROM", 0)
    monkeypatch.setattr(R, "key_bitmap", lambda *a: made.append(a) or real(*a))
    return made


def test_replay_behind_a_bitmap(spark, bitmaps):
    rows, df = changes(spark)
    rows += [(5000, "INSERT", None, 1), (5001, "DELETE", None, 1), (5002, "INSERT", 77, 2),
             (5003, "INSERT", 77, 2)]
    df = df.unionByName(spark.createDataFrame(rows[-4:], df.schema))
    got = [(r.seq, r.k, r.v) for r in R.live(df, ["k"]).collect()]
    known = [r for r in rows if r[2] is not None]
    assert sorted(x for x in got if x[1] is not None) == expected_live(known)
    assert [x for x in got if x[1] is None] == [(5000, None, 1)]     # a null key has no delete
    assert len(bitmaps) == 1


@pytest.mark.parametrize("every", [1, 2, 8])
def test_normaliser_behind_bitmaps(spark, scratch, bitmaps, every):
    rows, df = changes(spark, n=900)
    # Batches do not follow seq: some changes come late.
    df = df.withColumn("b", F.when(F.col("seq") % 7 == 0, 3).otherwise(
        (F.col("seq") / 300).cast("int")))
    df.write.parquet(os.path.join(scratch, "changes"))
    df = spark.read.parquet(os.path.join(scratch, "changes"))
    total = {}
    for b in range(4):
        signed = normalise(spark, lambda wanted: df.filter(F.col("b").isin(wanted)), b,
                           os.path.join(scratch, "log"), ["k"], every=every)
        for r in signed.collect():
            total[r.seq, r.k, r.v] = total.get((r.seq, r.k, r.v), 0) + r.w
        upto = df.filter(F.col("b") <= b).collect()
        expected = expected_live([(r.seq, r.op, r.k, r.v) for r in upto])
        assert sorted(x for x, w in total.items() if w) == expected
        assert all(w in (0, 1) for w in total.values())
    assert bitmaps


def test_rows_without_a_delete_are_not_shuffled(spark, scratch, bitmaps):
    """One key in ten was deleted: about one row in ten (and one in 16 by chance) is moved."""
    n = 50_000
    spark.range(n).select(F.col("id").alias("seq"), F.lit("INSERT").alias("op"), F.col("id").alias("k")) \
        .unionByName(spark.range(0, n, 10).select((F.col("id") + n).alias("seq"),
                                                  F.lit("DELETE").alias("op"), F.col("id").alias("k"))) \
        .write.parquet(os.path.join(scratch, "changes"))
    df = spark.read.parquet(os.path.join(scratch, "changes"))
    live = R.live(df, ["k"])
    assert live.count() == n - n // 10
    joined = R.join_deletes(df.filter("op = 'INSERT'"), R.stored(
        R.last_delete(df, ["k"]), "deletes"), ["k"])
    assert joined.count() == n
    dels = R.stored(R.last_delete(df, ["k"]), "deletes")
    moved = R.may_match(df.filter("op = 'INSERT'"), ["k"], *R.bitmap_of(dels, ["k"]))
    assert n // 10 <= moved.count() < n // 10 + 2 * n / 16


def test_one_round_of_the_changelog(spark):
    t = {"customer": spark.range(2000).select(
            F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"),
            F.lit(1).alias("c_nationkey"), F.lit("1.00").cast("decimal(12,2)").alias("c_acctbal"),
            F.when(F.col("id") % 2 == 0, "A").alias("c_mktsegment"))}
    every = S.round_changes(t).collect()
    assert len(every) == 2000 + 182 + 200 + 100
    for r in range(4):
        only = S.round_changes(t, only=r)
        assert sorted(only.collect()) == sorted(x for x in every if x.rnd == r)
