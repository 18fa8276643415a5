"""Reconciliation edge cases (E5-E7) and the result CSV reader."""

import datetime as dt
import os
from decimal import Decimal

from deltaq.operators import reconcile as E
from deltaq.schemas import RESULT_SCHEMA
from deltaq.sources import files as FS

ROWS = [(1, dt.date(1995, 1, 1), 0, Decimal("1.5000")), (2, dt.date(1995, 1, 2), 0,
                                                          Decimal("2.0000"))]


def frame(spark, rows):
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def summary(spark, exp, act):
    return E.reconcile(frame(spark, exp), frame(spark, act)).summary().collect()[0].asDict()


def test_identical_sets(spark):
    s = summary(spark, ROWS, ROWS + ROWS[:1])   # duplicates do not count (sets)
    assert s == {"n_expected": 2, "n_actual": 2, "n_matching": 2, "n_missing": 0,
                 "n_extra": 0, "accuracy": 100.0, "identical": True}


def test_empty_sides(spark):
    assert summary(spark, [], [])["accuracy"] is None
    assert summary(spark, ROWS, [])["accuracy"] == 0.0
    assert summary(spark, [], ROWS)["accuracy"] == 0.0


def test_partial_match_and_preview(spark):
    act = [ROWS[0], (3, dt.date(1995, 1, 3), 0, Decimal("3.0000"))]
    s = summary(spark, ROWS, act)
    assert (s["n_matching"], s["n_missing"], s["n_extra"], s["accuracy"]) == (1, 1, 1, 50.0)
    many = [(k, dt.date(1995, 1, 1), 0, Decimal("1.0000")) for k in range(12, 0, -1)]
    prev = E.preview(frame(spark, many), "missing").orderBy("rn").collect()
    assert [r.l_orderkey for r in prev] == [1, 2, 3, 4, 5]
    assert {r.remaining for r in prev} == {7}


def test_result_csv_reader_skips_bad_rows(spark, scratch):
    path = os.path.join(scratch, "out")
    FS.write_result_csv(frame(spark, ROWS), path)
    extra = os.path.join(path, "part-zzz.csv")
    with open(extra, "w") as f:
        f.write("l_orderkey, o_orderdate, o_shippriority, revenue\n"
                "7, 1995-01-07, 0, 13272.06725\n"       # rounded HALF_UP
                "8, not-a-date, 0, 1.0\n"              # bad cell: skipped
                "9, 1995-01-09, 0\n")                   # wrong width: skipped
    got = {(r.l_orderkey, str(r.revenue)) for r in FS.read_result_csv(spark, path).collect()}
    assert got == {(1, "1.5000"), (2, "2.0000"), (7, "13272.0673")}
