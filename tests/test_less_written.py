"""What the steps write and move beside their results: no more than is read."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from deltaq.operators import bitmap as B
from deltaq.operators import reconcile_tree as T
from deltaq.operators import replay as R
from deltaq.operators.replay import stored
from deltaq.sources import changelog as C
from deltaq.streaming import normalise as N
from deltaq.streaming.normalise import normalise


def test_parts_of_a_changelog_follow_its_lines_and_are_packed(spark, scratch, monkeypatch):
    monkeypatch.setattr(C, "PART_LINES", 20)
    path = os.path.join(scratch, "text")
    spark.range(1000).select((F.col("id") * 7919 % 1000).alias("seq"),
                             F.concat(F.lit("line "), F.col("id") * 7919 % 1000).alias("line")
                             ).write.parquet(os.path.join(scratch, "changes"))
    changes = spark.read.parquet(os.path.join(scratch, "changes"))
    C.write_changelog(changes, path)
    files = glob.glob(os.path.join(path, "part-*"))
    assert len(files) > 40 and all(f.endswith(".txt.gz") for f in files)
    lines = [r["value"] for r in C.read_changelog(spark, path).orderBy("seq").collect()]
    assert lines == [f"line {i}" for i in range(1000)]


@pytest.mark.parametrize("ahead", [True, False])
def test_a_compaction_that_no_batch_reads_is_not_written(spark, scratch, ahead):
    log = os.path.join(scratch, "log")
    rows = [(1, "INSERT", 1, 0), (2, "INSERT", 2, 0), (3, "DELETE", 1, 1), (4, "INSERT", 1, 2),
            (5, "DELETE", 2, 3), (6, "INSERT", None, 3)]
    df = spark.createDataFrame(rows, "seq bigint, op string, k bigint, b int")
    got = [sorted((r.seq, r.k, r.w) for r in normalise(
        spark, lambda wanted: df.filter(F.col("b").isin(wanted)), b, log, ["k"], every=2,
        ahead=ahead).collect()) for b in range(4)]
    assert got == [[(1, 1, 1), (2, 2, 1)], [(1, 1, -1)], [(4, 1, 1)], [(2, 2, -1), (6, None, 1)]]
    folds = sorted(n for n in os.listdir(os.path.join(log, "compact")) if n.startswith("upto="))
    assert folds == (["upto=1", "upto=3"] if ahead else ["upto=1"])


@pytest.mark.parametrize("null", [False, True])
def test_earlier_rows_meet_the_bitmap_before_they_are_shuffled(spark, scratch, monkeypatch, null):
    """The join to a batch's keys stays above the bitmap that keeps other keys' rows in place."""
    monkeypatch.setattr(R, "FILTER_FROM", 1)
    plans = []

    def step(df, log_path, name, old=N._step):
        if name == "touched_rows":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return old(df, log_path, name)
    monkeypatch.setattr(N, "_step", step)
    rows = [(i, "INSERT", i, 0) for i in range(50)] + [(60, "DELETE", 7, 2), (61, "DELETE", 9, 2)]
    rows += [(5, "INSERT", 7, 1)] + ([(70, "INSERT", None, 1), (71, "DELETE", None, 2)] if null else [])
    df = spark.createDataFrame(rows, "seq bigint, op string, k bigint, b int")
    got = [sorted((r.seq, r.k, r.w) for r in normalise(
        spark, lambda wanted: df.filter(F.col("b").isin(wanted)), b, scratch, ["k"], every=2,
        ahead=False).collect()) for b in range(3)]
    assert got[0] == [(i, i, 1) for i in range(50)]
    assert got[1] == [(5, 7, 1)] + [(70, None, 1)] * null
    assert got[2] == [(5, 7, -1), (7, 7, -1), (9, 9, -1)]
    assert len(plans) == 2
    for plan in plans:
        tree = plan.splitlines()
        keys = next(i for i, line in enumerate(tree) if "<=>" in line)
        assert "Join" in tree[keys] and "getbit" in "".join(tree[keys + 1:])


def test_a_bitmap_tells_every_bit(spark):
    """Every second of 70,000 keys, in as many bits: all that are in pass, of the others some."""
    keys = spark.range(0, 70_000, 2).select(F.col("id").alias("k"))
    bits = 1 << 20
    bitmap = stored(B.key_bitmap(keys, "k", bits), "bits")
    every = spark.range(70_000).select(F.col("id").alias("k"))
    passed = B.may_match(every, "k", bitmap, bits)
    assert passed.filter("k % 2 = 0").count() == 35_000
    assert passed.filter("k % 2 = 1").count() < 35_000 // 16
    left = B.cannot_match(every, "k", bitmap, bits)
    assert left.count() + passed.count() == 70_000 and left.filter("k % 2 = 0").count() == 0


def test_tables_without_repeated_rows_are_not_written_again(spark):
    rows = stored(spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (None, None)],
                                        "k bigint, a string"), "rows")
    assert T._once(rows, "once") is rows
    twice = rows.unionByName(rows.filter("k is null"))
    assert sorted(map(repr, T._once(twice, "twice").collect())) == sorted(map(repr, rows.collect()))
