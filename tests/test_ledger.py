"""Hand-made cases: every way must give the sequential replay's answer (FIXTURES section 4)."""

import pytest

from .helpers import (batch_result, cust, item, normalised_result, order, python_replay)

CASES = {
    "twin_items": [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1),
                   item("INSERT", 10, 1)],
    "twin_items_before_order": [item("INSERT", 10, 1), item("INSERT", 10, 1),
                                cust("INSERT", 1), order("INSERT", 10, 1)],
    "phantom_order_delete": [cust("INSERT", 1), order("DELETE", 10, 1), order("INSERT", 10, 1),
                             item("INSERT", 10, 1)],
    "phantom_customer_delete": [cust("DELETE", 1), cust("INSERT", 1), order("INSERT", 10, 1),
                                item("INSERT", 10, 1)],
    "all_items_removed": [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1),
                          item("DELETE", 10, 1)],
    "real_zero": [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1, disc="1.00")],
    "repeated_insert": [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1),
                        order("INSERT", 10, 1), item("INSERT", 10, 2)],
    "repeated_insert_then_delete": [cust("INSERT", 1), order("INSERT", 10, 1),
                                    order("INSERT", 10, 1), item("INSERT", 10, 1),
                                    order("DELETE", 10, 1)],
    "delete_with_other_payload": [cust("INSERT", 1), order("INSERT", 10, 1),
                                  item("INSERT", 10, 1), cust("DELETE", 1, seg="BUILDING")],
    "boundary_dates": [cust("INSERT", 1), order("INSERT", 10, 1, date="1995-03-13"),
                       item("INSERT", 10, 1), order("INSERT", 11, 1), 
                       item("INSERT", 11, 1, ship="1995-03-13")],
    "segment_case": [cust("INSERT", 1, seg="automobile"), order("INSERT", 10, 1),
                     item("INSERT", 10, 1)],
    "reinsert_after_delete": [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1),
                              cust("DELETE", 1), cust("INSERT", 1), item("INSERT", 10, 2)],
}

EXPECTED_GROUPS = {
    "twin_items": 1, "twin_items_before_order": 1, "phantom_order_delete": 1,
    "phantom_customer_delete": 1, "all_items_removed": 0, "real_zero": 1,
    "repeated_insert": 1, "repeated_insert_then_delete": 0, "delete_with_other_payload": 0,
    "boundary_dates": 0, "segment_case": 0, "reinsert_after_delete": 1,
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_batch_replay_matches_sequential_replay(spark, name):
    lines = CASES[name]
    expected = python_replay(lines)
    assert len(expected) == EXPECTED_GROUPS[name]
    assert batch_result(spark, lines) == expected


def test_twins_count_twice_and_repeated_orders_multiply(spark):
    twin = batch_result(spark, CASES["twin_items"])
    assert {r[3] for r in twin} == {"180.0000"}
    rep = batch_result(spark, CASES["repeated_insert"])
    assert {r[3] for r in rep} == {"360.0000"}   # 2 items x 2 copies of the order x 90
    zero = batch_result(spark, CASES["real_zero"])
    assert {r[3] for r in zero} == {"0.0000"}


@pytest.mark.parametrize("name,cuts", [("twin_items_before_order", [2]),
                                       ("repeated_insert_then_delete", [1, 3]),
                                       ("reinsert_after_delete", [3]),
                                       ("all_items_removed", [])])
def test_any_micro_batch_split_gives_the_same_answer(spark, scratch, name, cuts):
    lines = CASES[name]
    assert normalised_result(spark, lines, cuts, scratch) == python_replay(lines)


def test_compaction_every_batch_keeps_the_answer(spark, scratch):
    lines = CASES["reinsert_after_delete"] + [item("DELETE", 10, 2), item("INSERT", 10, 2),
                                             cust("DELETE", 1), cust("INSERT", 1)]
    cuts = [2, 4, 6, 7, 9]
    assert normalised_result(spark, lines, cuts, scratch, every=1) == python_replay(lines)


def test_late_delete_arriving_in_an_earlier_batch(spark, scratch):
    # seq 0..4 are the changes; the DELETE (seq 4) arrives in batch 0, its INSERT (seq 3) later
    lines = [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 2),
             item("INSERT", 10, 1), item("DELETE", 10, 1)]
    from deltaq.operators import parse as P
    from deltaq.plans.incremental import live_groups, q3_from_signed
    from deltaq.schemas import REFERENCE
    from deltaq.streaming.normalise import normalise
    from pyspark.sql import functions as F
    import os
    from .helpers import as_set, lines_df
    r = P.route_all(P.parse(lines_df(spark, lines), REFERENCE), REFERENCE)
    order_of_arrival = {0: [0, 1, 4], 1: [2, 3]}
    signed = {}
    for t, df in r.items():
        changes = df.withColumn("b", F.when(F.col("seq").isin(order_of_arrival[0]), 0)
                                .otherwise(1))

        def read(batches, changes=changes):
            return changes.filter(F.col("b").isin(batches))
        for b in order_of_arrival:
            out = normalise(spark, read, b, os.path.join(scratch, "log", t),
                            REFERENCE[t].key, every=1)
            out.write.mode("overwrite").parquet(os.path.join(scratch, "signed", t, f"b={b}"))
        signed[t] = spark.read.parquet(os.path.join(scratch, "signed", t))
    got = as_set(live_groups(q3_from_signed(signed)))
    assert got == python_replay(lines)
    assert {g[3] for g in got} == {"90.0000"}   # only line 2 remains
