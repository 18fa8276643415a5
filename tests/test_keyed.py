"""Joins in Spark's keyed state: right answers in any order, existence, and state that shrinks."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from deltaq.schemas import REFERENCE
from deltaq.sources.changelog import ARRIVAL
from deltaq.streaming import incremental as I
from deltaq.streaming import keyed as K

from .helpers import as_set, cust, item, order, python_replay


def feed(spark, scratch, steps, after, layout=REFERENCE):
    paths = I.Paths(os.path.join(scratch, "work"))
    text = os.path.join(scratch, "in")
    os.makedirs(text)
    for n, lines in enumerate(steps):
        with open(os.path.join(text, f"f{n}.txt"), "w") as out:
            out.write("".join(x + "\n" for x in lines))
        I.run_changes(spark, text, paths, layout, order=ARRIVAL)
        after(paths, n)
    return paths


STEPS = [
    [order("INSERT", 10, 1), item("INSERT", 10, 1), order("INSERT", 11, 2), item("INSERT", 11, 1)],
    [cust("INSERT", 1), cust("INSERT", 1), cust("INSERT", 2), item("INSERT", 10, 2, price="7.00")],
    [order("DELETE", 11, 2), item("DELETE", 10, 1), cust("INSERT", 1), order("INSERT", 12, 1),
     item("INSERT", 12, 1)],
    [cust("DELETE", 1), order("INSERT", 11, 2)],
    [cust("INSERT", 1), item("DELETE", 12, 1), item("INSERT", 12, 3, price="3.00")]]


@pytest.mark.parametrize("salts", [1, 3])
def test_result_after_every_batch(spark, scratch, salts):
    seen = []

    def check(paths, n):
        K.drain(spark, paths, salts)
        lines = [x for step in STEPS[:n + 1] for x in step]
        assert as_set(K.keyed_snapshot(spark, paths)) == python_replay(lines), n
        seen.append(n)

    feed(spark, scratch, STEPS, check)
    assert seen == list(range(5))


def test_repeated_partners_do_not_multiply_rows(spark, scratch):
    def gate(paths, n):
        q = I.start_sink(K.gated_orders(spark, I.prepare(spark, paths), 2), paths.of("gated"),
                         paths.of("checkpoints", "gated"))
        I.drained(q)
        rows = spark.read.schema(K.JOINED_ORDERS).parquet(paths.of("gated"))
        now = {r.o_orderkey: r.w for r in
               rows.groupBy("o_orderkey").agg(F.sum("w").alias("w")).filter("w <> 0").collect()}
        live, customers = Counter(), Counter()
        for line in [x for step in STEPS[:n + 1] for x in step]:
            op, table, key, *rest = line.split("|")
            if table == "customer":
                customers[key] = customers[key] + 1 if op == "INSERT" else 0
            elif table == "orders":
                live[key, rest[0]] = live[key, rest[0]] + 1 if op == "INSERT" else 0
        assert now == {int(o): n for (o, c), n in live.items() if n and customers[c]}

    feed(spark, scratch, STEPS, gate)


def test_state_stays_flat_while_rows_come_and_go(spark, scratch):
    keys = range(20)
    up = [x for k in keys for x in (cust("INSERT", k), order("INSERT", k, k), item("INSERT", k, 1))]
    down = [x for k in keys for x in (item("DELETE", k, 1), order("DELETE", k, k),
                                      cust("DELETE", k))]
    rows = []

    def count(paths, n):
        rows.append([sum(s["numRowsTotal"] for s in p["stateOperators"])
                     for p in K.drain(spark, paths, 1)])

    paths = feed(spark, scratch, [up, down, up, down, up, down, up], count)
    assert rows[0] == rows[2] == rows[4] == rows[6] and min(rows[0]) >= 20
    assert rows[1] == rows[3] == rows[5] == [0, 0]
    assert as_set(K.keyed_snapshot(spark, paths)) == python_replay(up)


def test_keys_and_salts_that_share_a_bucket_stay_apart(spark, scratch, monkeypatch):
    """One bucket for all keys and salts: the same result, and its state is read and written once a
    side and micro-batch, not once a key."""
    join = K.keyed_join
    monkeypatch.setattr(K, "keyed_join", lambda *a, **b: join(*a, **b, buckets=1))
    rows = []

    def check(paths, n):
        rows.append([sum(s["numRowsTotal"] for s in p["stateOperators"])
                     for p in K.drain(spark, paths, 3)])
        lines = [x for step in STEPS[:n + 1] for x in step]
        assert as_set(K.keyed_snapshot(spark, paths)) == python_replay(lines), n

    feed(spark, scratch, STEPS[:3], check)
    assert max(max(r) for r in rows) == 2


def test_a_session_without_rocksdb_gets_it_for_the_keyed_queries_only(spark, scratch):
    """The session's state store has no keyed state (Spark's default); its settings stay its own."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(provider)
    default = old.rsplit(".", 1)[0] + ".HDFSBackedStateStoreProvider"
    spark.conf.set(provider, default)
    try:
        paths = feed(spark, scratch, STEPS[:2], lambda paths, n: K.drain(spark, paths, 1))
        assert spark.conf.get(provider) == default
    finally:
        spark.conf.set(provider, old)
    lines = [x for step in STEPS[:2] for x in step]
    assert as_set(K.keyed_snapshot(spark, paths)) == python_replay(lines)
