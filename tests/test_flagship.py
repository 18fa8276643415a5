"""The flagship beyond a broadcast order side: filter before the shuffle, co-located tables."""

from pyspark.sql import functions as F

from deltaq.plans import q3 as Q
from deltaq.sources.tables import load_tables, with_shippriority

SF = "/root/testdata/sf0.01"


def tables(spark):
    t = load_tables(spark, SF)
    return t["customer"], with_shippriority(t["orders"]), t["lineitem"]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_filter_keeps_every_match_and_little_else(spark):
    customer, orders, lineitem = tables(spark)
    ords = Q.counted_orders(customer, orders)
    items = Q.qualifying_items(lineitem)
    bits = ords.count() * Q.FILTER_BITS
    kept = Q.may_match(items, "l_orderkey", Q.key_bitmap(ords, "o_orderkey", bits), bits)
    match = F.col("l_orderkey") == F.col("o_orderkey")
    total, n, matching = items.count(), kept.count(), items.join(ords, match, "left_semi").count()
    assert kept.join(ords, match, "left_semi").count() == matching
    assert n - matching < 2 * (total - matching) / Q.FILTER_BITS
    assert n < total / 5
    assert kept.columns == items.columns


def test_filter_of_nulls_negative_and_repeated_keys(spark):
    keys = spark.createDataFrame([(-5,), (0,), (0,), (2**62,), (None,)], "o_orderkey long")
    rows = spark.createDataFrame([(-5,), (0,), (2**62,), (2**62,), (None,)], "l_orderkey long")
    for bits in (1, 40, 1 << 20):
        kept = Q.may_match(rows, "l_orderkey", Q.key_bitmap(keys, "o_orderkey", bits), bits)
        assert sorted(r[0] for r in kept.collect() if r[0] is not None) == [-5, 0, 2**62, 2**62]
    none = Q.key_bitmap(keys.limit(0), "o_orderkey", 16)
    assert Q.may_match(rows, "l_orderkey", none, 16).collect() == []


def test_every_plan_gives_the_same_rows(spark):
    t = tables(spark)
    want = sorted(map(tuple, Q.q3(*t).collect()))
    assert want
    assert sorted(map(tuple, Q.q3(*t, broadcast_orders=-1).collect())) == want
    assert sorted(map(tuple, Q.q3(*t, broadcast_orders=-1, filter_orders=-1).collect())) == want


def test_no_exchange_under_the_colocated_join(spark):
    customer, orders, lineitem = tables(spark)
    items = Q.colocate_items(lineitem, 4)
    df = Q.q3_colocated(customer, orders, items, 4)
    plan = executed(df)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, Q.q3(customer, orders, lineitem)
                                                          .collect()))
    assert "Exchange" not in plan[plan.index("SortMergeJoin"):]


def test_a_hot_order_is_dealt_over_buckets(spark):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("l_orderkey"), "id")
    items = Q.colocate_items(rows, 16)
    assert items.groupBy("_salt").count().agg(F.max("count")).first()[0] < 4000 / Q.SALTS * 1.5
    assert items.select(F.input_file_name().alias("f")).select(
        F.regexp_extract("f", r"_(\d{5})\.c", 1)).distinct().count() > 2
