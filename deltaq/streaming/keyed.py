"""Join sides in Spark's own keyed state (J1-J4, J7): rows leave it when their weight nets to zero.

``keyed_join`` joins two streams of signed rows on a key.  Both sides' net rows are value states of
``transformWithState`` (RocksDB, with Spark's checkpoints and commit log; nothing is kept in folders
of our own).  A micro-batch adds its weights to the state, drops what nets to zero, and gives the
change of the product:

    change = (left after - left before) x right before  +  left after x (right after - right before)

Alternating inserts and deletes of the same rows leave the state as small as the live rows.

Every call on the state is a round trip between Python and the JVM, so keys do not get a state each:
they are dealt over ``buckets`` by a hash, and a bucket's rows are read and written at once, a side
that a micro-batch leaves alone not at all.  A micro-batch costs the rows of the buckets that its keys
fall into; a bucket should hold some thousands of rows.

``semi`` turns the left weight into existence: the right rows come when the number of live partners
of their key passes zero upwards, go when it passes back, and repeated partners change nothing (J7).

Hot keys: the left side is copied to ``salts`` salts and each right row goes to the one its own hash
gives, so the right rows of one key are spread over buckets.  Both sides are summed per
batch and row before they get here.

A key that is null joins nothing and is left out.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from decimal import Decimal

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .incremental import (
    CUSTOMER_SALTS, GROUP, WREV, Paths, drained, prepare, q3_stream, start_sink)
from ..functions.expressions import to_revenue
from ..session import keyed_state

# The processor travels with the query, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VALUE = "w bigint, rev decimal(38,4)"
#: Buckets of the keys of a join; a parameter of its state, fixed once that is written.
BUCKETS = 4096
_SCALE = 4


class JoinState(StatefulProcessor):
    """Net rows of one bucket, by key and salt (a key may be there with several): left columns -> w,
    and right columns -> (w, rev), with ``rev`` as a whole number of its smallest unit."""

    def __init__(self, key: str, left: Sequence[str], right: Sequence[str], out: Sequence[str],
                 semi: bool) -> None:
        self.key, self.left_names, self.right_names = key, list(left), list(right)
        self.out, self.semi = list(out), semi

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getValueState("left", "rows binary")
        self.right = handle.getValueState("right", "rows binary")
        self.row = Row(*self.out)

    def _weights(self, left: dict[tuple, int]) -> dict[tuple, int]:
        if not self.semi:
            return left
        return {(): 1} if sum(left.values()) > 0 else {}

    @staticmethod
    def _held(state) -> dict:
        rows = state.get() if state.exists() else None
        return pickle.loads(rows[0]) if rows else {}

    @staticmethod
    def _keep(state, rows: dict) -> None:
        if rows:
            state.update((pickle.dumps(rows, pickle.HIGHEST_PROTOCOL),))
        else:
            state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        left: dict[object, dict[tuple, int]] = {}
        right: dict[object, dict[tuple, list[int]]] = {}
        places = None
        for r in rows:
            if places is None:
                at = {c: i for i, c in enumerate(r.__fields__)}
                places = (at[self.key], at["_salt"], at["_left"], at["w"], at["rev"],
                          [at[c] for c in self.left_names], [at[c] for c in self.right_names])
            k, salt, is_left, w, rev, own_left, own_right = places
            k = r[k], r[salt]
            if r[is_left]:
                own = left.setdefault(k, {})
                at = tuple([r[i] for i in own_left])
                own[at] = own.get(at, 0) + r[w]
            else:
                sums = right.setdefault(k, {}).setdefault(tuple([r[i] for i in own_right]), [0, 0])
                sums[0] += r[w]
                sums[1] += int(r[rev].scaleb(_SCALE))
        lefts, rights = self._held(self.left), self._held(self.right)
        # The left side first: its change meets the right rows before, the right change its new rows.
        for k, own in left.items():
            before = lefts.get(k, {})
            after = dict(before)
            for at, w in own.items():
                after[at] = after.get(at, 0) + w
                if not after[at]:
                    del after[at]
            if after:
                lefts[k] = after
            else:
                lefts.pop(k, None)
            old, new = self._weights(before), self._weights(after)
            change = {at: d for at in {**old, **new} if (d := new.get(at, 0) - old.get(at, 0))}
            if change:
                for at, (w, rev) in rights.get(k, {}).items():
                    yield from self._rows(k, change, at, w, rev)
        for k, own in right.items():
            now, held = self._weights(lefts.get(k, {})), rights.setdefault(k, {})
            for at, (w, rev) in own.items():
                if w or rev:
                    yield from self._rows(k, now, at, w, rev)
                    more = held.pop(at, (0, 0))
                    w, rev = more[0] + w, more[1] + rev
                    if w or rev:
                        held[at] = (w, rev)
            if not held:
                del rights[k]
        if left:
            self._keep(self.left, lefts)
        if right:
            self._keep(self.right, rights)

    def _rows(self, key: tuple, left: dict[tuple, int], right: tuple, w: int, rev: int,
              ) -> Iterator[Row]:
        for at, n in left.items():
            payload = () if self.semi else at
            yield self.row(key[0], *payload, *right, n * w, Decimal(n * rev).scaleb(-_SCALE))

    def close(self) -> None:
        pass


def keyed_join(left: DataFrame, right: DataFrame, key: str, salts: int = 1, semi: bool = False,
               buckets: int = BUCKETS) -> DataFrame:
    """Change of the join of two streams on the column ``key`` of both: the key, the left side's
    columns (none with ``semi``), the right side's, ``w`` and ``rev``.  Both sides carry ``w``
    (bigint); the right one may carry ``rev``, an amount that is already weighted."""
    def columns(df: DataFrame) -> list[tuple[str, str]]:
        return [(c, t) for c, t in df.dtypes if c not in (key, "w", "rev")]

    def side(df: DataFrame, is_left: bool, salt: Column) -> DataFrame:
        own = dict(columns(df))
        every = [(c, t) for d in (left, right) for c, t in columns(d)]
        rev = F.col("rev") if "rev" in df.columns else F.lit(0)
        bucket = F.pmod(F.xxhash64(F.col(key), F.col("_salt").cast("int")), F.lit(buckets))
        return df.filter(F.col(key).isNotNull()).withColumn("_salt", salt).select(
            F.col(key), F.col("_salt").cast("int").alias("_salt"),
            bucket.cast("int").alias("_bucket"), F.lit(is_left).alias("_left"),
            *[(F.col(c) if c in own else F.lit(None)).cast(t).alias(c) for c, t in every],
            F.col("w").cast("bigint").alias("w"), rev.cast(WREV).alias("rev"))

    names = [c for c, _ in columns(right)]
    salt = F.pmod(F.xxhash64(*names), F.lit(salts)) if names and salts > 1 else F.lit(0)
    n = salts if names else 1
    both = side(left, True, F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).unionByName(
        side(right, False, salt))
    out = [(key, dict(left.dtypes)[key]), *([] if semi else columns(left)), *columns(right)]
    schema = ", ".join(f"{c} {t}" for c, t in out) + f", {VALUE}"
    state = JoinState(key, [c for c, _ in columns(left)], names, [c for c, _ in out] + ["w", "rev"],
                      semi)
    return both.groupBy("_bucket").transformWithState(
        statefulProcessor=state, outputStructType=schema, outputMode="append", timeMode="none")


def _customers(spark: SparkSession, paths: Paths) -> DataFrame:
    return q3_stream(spark, paths, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("cw").alias("w"))


def _orders(spark: SparkSession, paths: Paths) -> DataFrame:
    return q3_stream(spark, paths, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_shippriority", F.col("ow").alias("w"))


def gated_orders(spark: SparkSession, paths: Paths, salts: int = CUSTOMER_SALTS) -> DataFrame:
    """J7 in the stream: changes of the orders that have a live customer in the segment."""
    return keyed_join(_customers(spark, paths), _orders(spark, paths), "o_custkey", salts, semi=True)


def customer_orders(spark: SparkSession, paths: Paths, salts: int = CUSTOMER_SALTS) -> DataFrame:
    """Changes of customer x orders."""
    return keyed_join(_customers(spark, paths), _orders(spark, paths), "o_custkey", salts)


JOINED_ORDERS = ("o_custkey bigint, o_orderkey bigint, o_orderdate date, o_shippriority int, "
                 "w bigint, rev decimal(38,4)")


def order_items(spark: SparkSession, paths: Paths) -> DataFrame:
    """Changes of (customer x orders) x line items; items are summed per order and batch, so
    an order of any size is one row of its state."""
    orders = (spark.readStream.schema(JOINED_ORDERS).parquet(paths.of("keyed_orders"))
              .select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_shippriority", "w"))
    items = q3_stream(spark, paths, "lineitem").select(
        "l_orderkey", F.col("lw").alias("w"), F.col("lrev").alias("rev"))
    return keyed_join(orders, items, "l_orderkey")


def start_keyed(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changes that a keyed join gives, with the state store it needs."""
    with keyed_state(df.sparkSession):
        return start_sink(df, path, checkpoint)


def drain(spark: SparkSession, paths: Paths, salts: int = CUSTOMER_SALTS) -> list[dict]:
    """Run both joins over what has arrived; the progress of their last micro-batches."""
    prepare(spark, paths)
    done = []
    for name, make in (("keyed_orders", lambda: customer_orders(spark, paths, salts)),
                       ("keyed_delta", lambda: order_items(spark, paths))):
        query = start_keyed(make(), paths.of(name), paths.of("checkpoints", name))
        drained(query)
        done.append(query.lastProgress)
    return done


def keyed_snapshot(spark: SparkSession, paths: Paths) -> DataFrame:
    """The current result from the delta log of the keyed joins."""
    schema = ("l_orderkey bigint, o_orderdate date, o_shippriority int, w bigint, "
              "rev decimal(38,4)")
    return (spark.read.schema(schema).parquet(paths.of("keyed_delta")).groupBy(*GROUP)
            .agg(F.sum("rev").alias("rev"), F.sum("w").alias("w")).filter(F.col("w") > 0)
            .select(*GROUP, to_revenue(F.col("rev")).alias("revenue")))
