"""Prefix sums over range partitions against a sequential scan."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deltaq.operators import running as U
from deltaq.schemas import REFERENCE

from .helpers import item, routes


def sequential(rows):
    out, sums, start = {}, {}, {}
    for g, t, v, stop in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1])):
        if start.get(g, True):
            sums[g] = 0
        sums[g] += v
        start[g] = stop
        out[g, t] = sums[g]
    return out


@pytest.mark.parametrize("restarts", [0.0, 0.02, 0.5])
@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_prefix_sums_with_a_hot_group(spark, restarts, partitions):
    rng = random.Random(partitions)
    rows = []
    for t in range(1500):       # a third and more of the rows in one group
        g = 5 if rng.random() < 0.4 else rng.choice([None, *range(60)])
        rows.append((g, t, rng.choice([1, -3, 2 ** 62, -2 ** 62, 10 ** 12]), rng.random() < restarts))
    df = spark.createDataFrame(rows, "g int, t int, v bigint, stop boolean").repartition(3)
    got = U.running_sums(df, ["g"], ["t"], ["v"], restart="stop", partitions=partitions)
    assert got.columns == ["g", "t", "v", "stop", "sum_v"]
    assert {(r.g, r.t): int(r.sum_v) for r in got.collect()} == sequential(rows)


def test_no_restart_column_and_small_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = [(t % 3, t, t, False) for t in range(200)]
        df = spark.createDataFrame(rows, "g int, t int, v bigint, stop boolean")
        got = U.running_sums(df, ["g"], ["t"], ["v"], partitions=4).collect()
        assert {(r.g, r.t): int(r.sum_v) for r in got} == sequential(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_and_null_groups(spark):
    df = spark.createDataFrame([(None, 1, 1)], "g int, t int, v bigint")
    assert U.running_sums(df, ["g"], ["t"], ["v"]).collect() == []
    assert U.running_sums(df.filter("t > 1"), ["g"], ["t"], ["v"]).collect() == []


def test_a_hot_group_spans_tasks_and_nothing_is_windowed_by_group(spark):
    df = spark.range(4000).select(F.lit(1).alias("g"), F.col("id").alias("t"), F.col("id").alias("v"))
    out = U.running_sums(df, ["g"], ["t"], ["v"], partitions=8)
    assert int(out.agg(F.max("sum_v")).first()[0]) == 4000 * 3999 // 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" not in plan


def test_deletes_take_away_all_copies(spark):
    lines = [item("DELETE", 1, 1), item("INSERT", 1, 1), item("INSERT", 1, 1, price="50.00"),
             item("INSERT", 1, 2, ship="1990-01-01"), item("INSERT", 1, 2), item("DELETE", 1, 1),
             item("DELETE", 1, 1), item("INSERT", 1, 1), item("INSERT", 2, 1),
             item("DELETE", 1, 2, ship="1990-01-01"), item("DELETE", 1, 1)]
    key = REFERENCE["lineitem"].key
    effects = U.line_item_effects(routes(spark, lines)["lineitem"], key, partitions=3)
    got = U.running_revenue(effects, ["l_orderkey"], partitions=3)
    assert [(r.seq, r.l_orderkey, r.revenue, r.live) for r in got.orderBy("seq").collect()] == [
        (1, 1, Decimal("90.0000"), 1), (2, 1, Decimal("135.0000"), 2),
        (4, 1, Decimal("225.0000"), 3), (5, 1, Decimal("90.0000"), 1),
        (7, 1, Decimal("180.0000"), 2), (8, 2, Decimal("90.0000"), 1),
        (9, 1, Decimal("90.0000"), 1), (10, 1, Decimal("0.0000"), 0)]
