"""Counts observed while batches run equal the audit of the bronze table, after restart and retry."""

import os

import pytest

from deltaq.schemas import REFERENCE
from deltaq.sources.changelog import ARRIVAL
from deltaq.streaming import incremental as I
from deltaq.streaming.live_audit import LiveAudit

from .helpers import cust, item, order

STEPS = [[cust("INSERT", 1), order("INSERT", 10, 1), "", "GARBAGE LINE", "UPSERT|part|1|2"],
         [item("INSERT", 10, 1), item("DELETE", 10, 1), "DELETE|lineitem|1|2",
          cust("upsert", 2), order("INSERT", "x", 1), order("delete", 10, 1)]]


def audited(spark, paths):
    """The audit of the bronze table in the groups of the live one."""
    out = {}
    for r in I.audit(spark, paths, REFERENCE).collect():
        key = (r.tbl if r.tbl in REFERENCE.table_names else None,
               r.op if r.op in ("INSERT", "DELETE") else "other", r.status)
        out[key] = out.get(key, 0) + r.n
    return out


def test_counts_survive_a_restart_and_a_retried_batch(spark, scratch):
    text, paths = os.path.join(scratch, "in"), I.Paths(os.path.join(scratch, "work"))
    os.makedirs(text)
    told = []
    failures = [1]

    def fails_once(fn):
        def run(batch, batch_id):
            fn(batch, batch_id)
            if batch_id == 1 and failures:
                failures.pop()
                raise RuntimeError("lost after the batch's writes")
        return run

    for n, lines in enumerate(STEPS):
        with open(os.path.join(text, f"f{n}.txt"), "w") as out:
            out.write("\n".join(lines) + "\n")
        live = LiveAudit(spark, paths.of("live"), REFERENCE, lambda b, rows: told.append((b, rows)))
        start = lambda: I.start_changes(
            spark, text, paths, REFERENCE, order=ARRIVAL, on_batch=live.watch, wrap=fails_once)
        if n:
            with pytest.raises(Exception, match="lost after"):
                I.drained(start())
        I.drained(start())
        got = {(r.tbl, r.op, r.status): r.n for r in live.counts().collect()}
        assert got == audited(spark, paths) and sum(got.values()) == sum(map(len, STEPS[:n + 1]))
    assert [b for b, _ in told] == [0, 1, 1] and told[1] == told[2]
    assert (None, "other", "blank", 1) in told[0][1]


def test_nothing_arrived_yet(spark, scratch):
    assert LiveAudit(spark, os.path.join(scratch, "live"), REFERENCE).counts().collect() == []
