"""The flagship three-table revenue query (TPC-H Q3 without ORDER BY / LIMIT).

``q3`` is the DataFrame form used everywhere (base tables, replayed tables, signed changes);
``q3_sql`` runs the same query from SQL text with named parameters (A8).

Plan shape: filter each table at the scan (the date casts unwrap into parquet pushed filters), join
the two selective sides first (orders x customers) and write the result, which is small beside the
line items.  Its row count is then known: up to ``BROADCAST_ORDERS`` rows it is broadcast and the
line items are never shuffled; beyond that both sides are shuffled on the order key, a skewed
partition (a hot order) is split by AQE (``forceOptimizeSkewedJoin``, since the GROUP BY sits on the
same key), and the partial aggregation collapses a hot key inside each task.  Up to
``FILTER_ORDERS`` rows, a bitmap of hashed order keys is broadcast first (128 MB at most), so only
line items that may match are shuffled.

``colocate_items`` stores line items bucketed on the order key; ``q3_colocated`` then joins without
an exchange of either side.

Pre-aggregating line items per order before the join was measured and rejected: the order-date
filter keeps about 3% of orders, so summing every shipped item first costs more than it saves.
Bag semantics come from the inner joins themselves (repeated rows multiply).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import ordered_before, revenue, segment_is, shipped_after, to_revenue
from ..operators.bitmap import FILTER_BITS, FILTER_KEYS, key_bitmap, may_match
from ..operators.replay import stored
from ..params import DEFAULT, Q3Params
from ..session import work_dir


def qualifying_customers(customer: DataFrame, params: Q3Params = DEFAULT) -> DataFrame:
    return customer.filter(segment_is(params)).select("c_custkey")


def qualifying_orders(orders: DataFrame, params: Q3Params = DEFAULT) -> DataFrame:
    return (orders.filter(ordered_before(params))
            .select("o_orderkey", "o_custkey", "o_orderdate", "o_shippriority"))


def qualifying_items(lineitem: DataFrame, params: Q3Params = DEFAULT) -> DataFrame:
    return lineitem.filter(shipped_after(params)).select("l_orderkey", revenue().alias("rev"))


#: Order rows (about 40 bytes each) up to which the order side is broadcast.
BROADCAST_ORDERS = 500_000


#: Order rows up to which the filter of their keys is made.
FILTER_ORDERS = FILTER_KEYS


def counted_orders(customer: DataFrame, orders: DataFrame, params: Q3Params = DEFAULT) -> DataFrame:
    """The orders that count, of customers that count (one row per pair), written."""
    return stored(qualifying_orders(orders, params).join(
        qualifying_customers(customer, params), F.col("o_custkey") == F.col("c_custkey"))
        .drop("o_custkey", "c_custkey"), "q3_orders")


def _by_order(joined: DataFrame) -> DataFrame:
    return (joined.groupBy("l_orderkey", "o_orderdate", "o_shippriority")
            .agg(to_revenue(F.sum("rev")).alias("revenue")))


def q3(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
       params: Q3Params = DEFAULT, broadcast_orders: int = BROADCAST_ORDERS,
       filter_orders: int = FILTER_ORDERS) -> DataFrame:
    ords = counted_orders(customer, orders, params)
    n = ords.count()
    items = qualifying_items(lineitem, params)
    if n <= broadcast_orders:
        ords = F.broadcast(ords)
    elif n <= filter_orders:
        bits = n * FILTER_BITS
        items = may_match(items, "l_orderkey",
                          stored(key_bitmap(ords, "o_orderkey", bits), "q3_filter"), bits)
    return _by_order(items.join(ords, F.col("l_orderkey") == F.col("o_orderkey")))


#: Buckets that a hot order's line items are dealt over; each order row is stored once for each.
SALTS = 8


def _bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    spark = df.sparkSession
    table = f"dq_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", work_dir(spark, name))
     .saveAsTable(table))
    return spark.table(table)


def colocate_items(lineitem: DataFrame, buckets: int) -> DataFrame:
    """Line items as a table bucketed on order key and a salt, laid out once for many queries.  Each
    task writes its own files of every bucket, so no task holds a hot order."""
    salted = lineitem.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    return _bucketed(salted, "items_by_order", buckets, "l_orderkey", "_salt")


def q3_colocated(customer: DataFrame, orders: DataFrame, items: DataFrame, buckets: int,
                 params: Q3Params = DEFAULT) -> DataFrame:
    """The flagship over ``colocate_items``: the order side, small beside the items, is bucketed the
    same way, and bucket joins bucket; only sums per order and salt are shuffled."""
    ords = counted_orders(customer, orders, params).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_osalt"))
    ords = _bucketed(ords, "orders_by_order", buckets, "o_orderkey", "_osalt")
    rows = items.filter(shipped_after(params)).select("l_orderkey", "_salt", revenue().alias("rev"))
    return _by_order(rows.join(ords.hint("merge"), (F.col("l_orderkey") == F.col("o_orderkey"))
                               & (F.col("_salt") == F.col("_osalt"))))


# The query text, with named parameters; views ``customer``, ``orders`` and ``lineitem`` are
# registered by the caller under the names given.
Q3_SQL = """
SELECT l_orderkey, o_orderdate, o_shippriority,
       CAST(ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS DECIMAL(18,4)) AS revenue
FROM {lineitem}, {customer}, {orders}
WHERE c_mktsegment = :segment
  AND c_custkey = o_custkey AND l_orderkey = o_orderkey
  AND o_orderdate < :order_date
  AND l_shipdate > :ship_date
GROUP BY l_orderkey, o_orderdate, o_shippriority
"""


def q3_sql(spark: SparkSession, customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
           params: Q3Params = DEFAULT, text: str = Q3_SQL, prefix: str = "dq_q3") -> DataFrame:
    """Run query text with named parameters over temp views of the given tables."""
    names = {t: f"{prefix}_{t}" for t in ("customer", "orders", "lineitem")}
    customer.createOrReplaceTempView(names["customer"])
    orders.createOrReplaceTempView(names["orders"])
    lineitem.createOrReplaceTempView(names["lineitem"])
    return spark.sql(text.format(**names), args={
        "segment": params.segment,
        "order_date": params.order_date,
        "ship_date": params.ship_date,
    })


def read_sql_file(spark: SparkSession, path: str) -> str:
    """The text of a ``.sql`` file on any Hadoop filesystem (one small file, one row)."""
    return spark.read.text(path, wholetext=True).first()["value"]


def write_sql_file(spark: SparkSession, path: str, text: str = Q3_SQL) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
