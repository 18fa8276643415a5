"""Validation, normalisation and routing of changelog lines."""

import pytest

from deltaq.operators import parse as P
from deltaq.schemas import DRIVER, REFERENCE

from .helpers import cust, item, lines_df, order

SAMPLE = ("INSERT|customer|57|Customer#57|12 Harbour Lane|4|14-555-010-2233|"
          "-98.40|MACHINERY|leaves parcels at the gate")


def verdicts(spark, lines, layout=REFERENCE):
    df = P.verdicts(P.parse(lines_df(spark, lines), layout), layout)
    return {r.seq: r.reason for r in df.collect()}


def test_reference_sample_line_is_accepted_and_typed(spark):
    r = P.route(P.parse(lines_df(spark, [SAMPLE]), REFERENCE), "customer", REFERENCE).collect()
    assert len(r) == 1
    assert r[0].c_custkey == 57 and str(r[0].c_acctbal) == "-98.40"
    assert r[0].c_mktsegment == "MACHINERY" and r[0].op == "INSERT"


def test_each_bad_line_gets_one_reason(spark):
    good = cust("INSERT", 1)
    lines = [
        "",                                   # 0 blank
        "   ",                                # 1 blank after strip
        "X",                                  # 2 too few parts
        "INSERT|customer",                    # 3 too few parts
        good.replace("INSERT", "UPSERT"),     # 4 unknown op
        "INSERT|part|1|2|3",                  # 5 unknown table
        good.rsplit("|", 1)[0],               # 6 one field short
        good + "|extra",                      # 7 one field too many
        order("INSERT", 1, 1, date="1995-02-30"),   # 8 bad date
        item("INSERT", 1, 1, price="12x.00"),        # 9 bad number
        "insert|Customer|" + good.split("|", 2)[2],  # 10 mixed case: accepted
        "  " + good + " \t",                  # 11 padded: accepted
        order("DELETE", 1, 1, date="bad"),    # 12 DELETE checks only its key: accepted
        "DELETE|orders|k1|1|O|1.00|1995-01-01|x|c|0|o",  # 13 DELETE with bad key
    ]
    got = verdicts(spark, lines)
    assert got == {0: "blank", 1: "blank", 2: "too_few_parts", 3: "too_few_parts",
                   4: "unknown_op", 5: "unknown_table", 6: "bad_arity", 7: "bad_arity",
                   8: "bad_value", 9: "bad_value", 10: None, 11: None, 12: None,
                   13: "bad_value"}


def test_quarantine_keeps_the_line_and_reason(spark):
    q = P.quarantine(P.parse(lines_df(spark, ["", cust("INSERT", 1)]), REFERENCE), REFERENCE)
    rows = q.collect()
    assert [(r.seq, r.value, r.reason) for r in rows] == [(0, "", "blank")]


def test_driver_layout_arity(spark):
    line = "INSERT|customer|7|Customer#7|3|1.50|BUILDING"
    assert verdicts(spark, [line], DRIVER) == {0: None}
    assert verdicts(spark, [line], REFERENCE) == {0: "bad_arity"}


def test_fail_policy_raises_on_bad_value(spark):
    lines = lines_df(spark, [order("INSERT", 1, 1, date="1995-02-30")])
    with pytest.raises(Exception):
        P.route(P.parse(lines, REFERENCE, policy=P.FAIL), "orders", REFERENCE).collect()


def test_bronze_keeps_typed_columns_and_prunes_the_scan(spark, scratch):
    """Accepted lines are stored typed, rejected ones as text; a route reads only what it needs."""
    from deltaq.sources.bronze import read_bronze, write_bronze
    lines = [cust("INSERT", 1), order("INSERT", 2, 1), "junk"]
    write_bronze(P.parse(lines_df(spark, lines), REFERENCE), scratch + "/b", REFERENCE)
    back = read_bronze(spark, scratch + "/b", REFERENCE, seq="bigint")
    assert {(r.seq, r.value) for r in back.collect()} == {(0, None), (1, None), (2, "junk")}
    q = P.route(back, "orders", REFERENCE).filter("o_orderdate < date'1995-06-01'").select(
        "o_orderkey")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "c_custkey" not in plan and "o_comment" not in plan
    assert "LessThan(o_orderdate" in plan and "(tbl" in plan
    assert [r.o_orderkey for r in q.collect()] == [2]


def test_verdicts_read_the_input_once(spark, scratch):
    path = scratch + "/lines"
    lines_df(spark, [cust("INSERT", 1), "junk"]).write.parquet(path)
    v = P.verdicts(P.parse(spark.read.parquet(path), REFERENCE), REFERENCE)
    assert v._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
