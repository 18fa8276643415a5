"""Replay operators on a changelog where one key holds most of the changes (spans many tasks)."""

import random

from pyspark.sql import functions as F

from deltaq.operators import replay as R


def changes(spark, n=3000, seed=7):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = 1 if rng.random() < 0.7 else rng.randint(2, 40)     # key 1 is hot
        op = "DELETE" if rng.random() < 0.3 else "INSERT"
        rows.append((seq, op, key, rng.randint(1, 3)))
    return rows, spark.createDataFrame(rows, "seq bigint, op string, k bigint, v int")


def expected_effects(rows):
    prev = {}
    out = {}
    for seq, op, key, _ in sorted(rows):
        if op == "DELETE":
            out[seq] = prev.get(key) == "INSERT"
        prev[key] = op
    return out


def expected_live(rows):
    last_del = {}
    for seq, op, key, _ in rows:
        if op == "DELETE":
            last_del[key] = max(seq, last_del.get(key, -1))
    return sorted((seq, key, v) for seq, op, key, v in rows
                  if op == "INSERT" and seq > last_del.get(key, -1))


def test_delete_effects_across_tasks(spark):
    rows, df = changes(spark)
    got = R.delete_effects(df, ["k"], partitions=16).collect()
    assert {r.seq: r.effective for r in got} == expected_effects(rows)


def test_delete_effects_composite_key(spark):
    rows, df = changes(spark, n=1500, seed=11)
    df = df.withColumn("k2", (F.col("k") % 2).cast("int"))
    got = R.delete_effects(df, ["k", "k2"], partitions=8).collect()
    assert {r.seq: r.effective for r in got} == expected_effects(rows)


def test_live_and_counts_with_hot_key(spark):
    rows, df = changes(spark)
    live = R.live(df, ["k"])
    assert sorted((r.seq, r.k, r.v) for r in live.collect()) == expected_live(rows)
    counts = {r.k: r.live for r in R.live_counts(live, ["k"]).collect()}
    exp = {}
    for _, key, _ in expected_live(rows):
        exp[key] = exp.get(key, 0) + 1
    assert counts == exp


def test_delete_effects_with_small_arrow_batches(spark):
    """Rows of one task arrive in many Arrow batches: the carry between batches must hold."""
    rows, df = changes(spark, n=2000, seed=3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = R.delete_effects(df, ["k"], partitions=4).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.seq: r.effective for r in got} == expected_effects(rows)


def test_compaction_keeps_live_rows_and_one_marker_per_deleted_key(spark, scratch):
    from deltaq.streaming.normalise import compact
    rows = [(1, "INSERT", 5, 1), (2, "DELETE", 5, None), (3, "INSERT", 5, 2),
            (4, "INSERT", 6, 3), (5, "DELETE", 7, None), (6, "DELETE", 7, None),
            (7, "INSERT", None, 4), (8, "DELETE", None, None)]
    df = spark.createDataFrame(rows, "seq bigint, op string, k bigint, v int")
    out = {(r.seq, r.op, r.k, r.v, r.b) for r in compact(df, ["k"], 9, scratch).collect()}
    assert out == {(3, "INSERT", 5, 2, 9), (4, "INSERT", 6, 3, 9), (7, "INSERT", None, 4, 9),
                   (2, "DELETE", 5, None, 9), (6, "DELETE", 7, None, 9),
                   (8, "DELETE", None, None, 9)}


def test_delete_effects_with_keys_that_floats_cannot_hold(spark):
    big = 2 ** 53
    rows = [(0, "INSERT", big, 1), (1, "DELETE", big + 1, 1), (2, "DELETE", big, 1)]
    df = spark.createDataFrame(rows, "seq bigint, op string, k bigint, v int")
    for n in (1, 4):
        got = {r.seq: r.effective for r in R.delete_effects(df, ["k"], partitions=n).collect()}
        assert got == {1: False, 2: True}


def skewed(spark, path, n=60_000):
    """Changes of which a third belong to one key; random payload, so that sizes stand out."""
    df = spark.range(n).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 50 == 1, "DELETE").otherwise("INSERT")
        .alias("op"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def with_skew_conf(spark, run):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = run()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_split_in_the_replay(spark, scratch):
    changes_ = skewed(spark, scratch + "/changes")
    assert "skew=true" in with_skew_conf(spark, lambda: R.live(changes_, ["k"]))


def test_a_hot_key_is_split_in_the_normaliser(spark, scratch):
    from deltaq.streaming.normalise import normalise
    changes_ = skewed(spark, scratch + "/changes").withColumn("b", F.lit(0))
    plan = with_skew_conf(spark, lambda: normalise(
        spark, lambda batches: changes_, 0, scratch + "/log", ["k"]))
    assert "skew=true" in plan


def test_a_hot_order_is_split_in_the_flagship_join(spark, scratch):
    import datetime as dt

    from deltaq.plans.q3 import q3
    n = 60_000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("l_orderkey"),
        (F.xxhash64("id") % 1000000 / 100).cast("decimal(12,2)").alias("l_extendedprice"),
        F.lit("0.10").cast("decimal(12,2)").alias("l_discount"),
        F.lit(dt.date(1995, 6, 1)).alias("l_shipdate"))
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"),
        F.lit(dt.date(1995, 1, 1)).alias("o_orderdate"), F.lit(0).alias("o_shippriority"))
    cust = spark.createDataFrame([(1, "AUTOMOBILE")], "c_custkey bigint, c_mktsegment string")
    items.write.parquet(scratch + "/items")
    items = spark.read.parquet(scratch + "/items")
    plan = with_skew_conf(spark, lambda: q3(cust, orders, items, broadcast_orders=0))
    assert "skew=true" in plan
    plan = with_skew_conf(spark, lambda: q3(cust, orders, items))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
