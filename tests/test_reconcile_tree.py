"""Reconciliation by checksum trees: the same answers as the full comparison, fewer rows compared."""

import os

import pytest
from pyspark.sql import functions as F

from deltaq.operators import reconcile_tree as T
from deltaq.operators.reconcile import reconcile
from deltaq.operators.replay import stored

SCHEMA = "k bigint, a string, b string, d decimal(12,2)"


def both_ways(exp, act, sets=False):
    """The tree's answers, checked against the full comparison."""
    tree, full = T.reconcile_tree(exp, act, "k", sets), reconcile(exp, act)

    def rows(df):
        return sorted(map(repr, df.collect()))
    assert rows(tree.missing) == rows(full.missing)
    assert rows(tree.extra) == rows(full.extra)
    assert rows(tree.matching) == rows(full.matching)
    assert tree.summary().collect() == full.summary().collect()
    return tree


def test_few_differences_in_a_large_table(spark):
    base = spark.range(300_000).select((F.col("id") * 977 - 10_000_000).alias("k"),
                                       F.concat(F.lit("x"), "id").alias("a"))
    exp = stored(base, "exp")
    act = stored(base.filter("k % 100003 <> 5").withColumn(
        "a", F.when(F.col("k") == 977 * 7 - 10_000_000, "other").otherwise(F.col("a"))).unionByName(
        spark.createDataFrame([(1, "new"), (2 ** 40, "far")], "k bigint, a string")), "act")
    tree = both_ways(exp, act, sets=True)
    differing = tree.missing.count() + tree.extra.count()
    assert 4 <= differing <= 20
    assert tree.n_compared <= 2 * T.ENOUGH * differing and tree.levels > 1


def test_equal_tables_move_no_row(spark):
    t = stored(spark.range(10_000).select(F.col("id").alias("k"), F.lit(None).cast("int").alias("a")),
               "same")
    tree = both_ways(t, t, sets=True)
    assert (tree.n_compared, tree.levels, tree.n_equal) == (0, 1, 10_000)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_nulls_repeats_negative_keys_and_hot_keys(spark):
    exp = [(None, "a", None, None), (-5, None, "x", None), (-5, None, "x", None), (7, "u", "v", None),
           (2 ** 62, "p", "q", None)] + [(9, f"t{i}", "h", None) for i in range(300)]
    act = [(None, "a", None, None), (None, None, "a", None), (-5, "x", None, None),
           (7, "u", "v", None), (7, "u", "v", None), (-2 ** 62, "p", "q", None)] + [
        (9, f"t{i}", "h", None) for i in range(1, 301)]
    tree = both_ways(frame(spark, exp), frame(spark, act))
    assert tree.n_equal == 1                        # the row of key 7, repeated on one side
    both_ways(frame(spark, exp), frame(spark, exp[::-1]))
    only_null = [r for r in exp if r[0] is None]
    both_ways(frame(spark, only_null), frame(spark, [(None, "b", None, None)]))


def test_empty_sides(spark):
    some, none = frame(spark, [(1, "a", "b", None)]), frame(spark, [])
    for exp, act in ((none, none), (some, none), (none, some)):
        both_ways(exp, act)


def test_more_open_nodes_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_NODES", 3)
    exp = spark.range(20_000).select((F.col("id") * 1000).alias("k"), F.lit("a").alias("a"))
    act = exp.withColumn("a", F.when(F.col("k") % 400_000 == 0, "b").otherwise(F.col("a")))
    tree = both_ways(stored(exp, "exp"), stored(act, "act"), sets=True)
    assert tree.levels == 1
    plan = tree.missing._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_bounds_reach_the_scan(spark):
    base = spark.range(50_000).select((F.col("id") * 100).alias("k"), F.lit("a").alias("a"))
    exp = stored(base, "exp")
    act = stored(base.withColumn("a", F.when(F.col("k") == 70_000, "b").otherwise(F.col("a"))), "act")
    tree = both_ways(exp, act, sets=True)
    plan = tree.missing._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k," in plan and "LessThanOrEqual(k," in plan


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["reconcile_tree_summary", "reconcile_tree_lineitem"])
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E
    from check_oracle import duck, rows_of

    df = E.queries()[name](spark, SF)
    rel = duck(SF).sql(E.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        rel.columns, rel.fetchall())
