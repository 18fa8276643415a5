"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Queries (wall time from submit to collected result):
  q3_batch    flagship query on the base tables
  replay_q3   rounds changelog (already written as text) -> parse -> bronze -> replay -> query
  stream_q3   same changelog through the streaming changes query (normaliser) and the
              stream-stream join query, then the snapshot

Batch queries: median of 5 after one warm-up.  The streaming query: median of
``BENCH_STREAM_RUNS`` (default 3) fresh runs, each with new state and checkpoints.  Writing the
changelog text is input preparation and is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deltaq.operators import parse as P  # noqa: E402
from deltaq.plans import changes as C  # noqa: E402
from deltaq.plans.catalog import _q3_of  # noqa: E402
from deltaq.schemas import DRIVER  # noqa: E402
from deltaq.session import local_session, retire_work, work_dir  # noqa: E402
from deltaq.sources.changelog import read_changelog, write_changelog  # noqa: E402
from deltaq.sources.tables import load_tables  # noqa: E402
from deltaq.streaming import incremental as I  # noqa: E402


def timed(fn) -> tuple[float, int]:
    t0 = time.perf_counter()
    rows = fn()
    return time.perf_counter() - t0, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "5"))
    stream_reps = int(os.environ.get("BENCH_STREAM_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus))

    text_dir = work_dir(spark, "bench_changelog")
    write_changelog(C.rounds(spark, sf_dir), text_dir)

    def q3_batch() -> int:
        return len(_q3_of(load_tables(spark, sf_dir)).collect())

    def replay_q3() -> int:
        parsed = P.parse(read_changelog(spark, text_dir), DRIVER)
        live = C.replayed(C.routed(C.staged(spark, parsed, "bench_bronze")))
        return len(_q3_of(live).collect())

    state_rows = []

    def stream_q3() -> int:
        paths = I.Paths(work_dir(spark, "bench_stream"))
        I.run_changes(spark, text_dir, paths, files_per_trigger=2, compact_every=2)
        q = I.start_join(spark, paths)
        q.awaitTermination()
        progress = [p for p in q.recentProgress if p.get("stateOperators")]
        state_rows.append(max((sum(op["numRowsTotal"] for op in p["stateOperators"])
                               for p in progress), default=0))
        return len(I.snapshot(spark, paths.delta).collect())

    results, rows = {}, {}
    for name, fn, n in (("q3_batch", q3_batch, reps), ("replay_q3", replay_q3, reps),
                        ("stream_q3", stream_q3, stream_reps)):
        fn()  # warm-up
        times = []
        for _ in range(n):
            t, r = timed(fn)
            times.append(t)
            rows[name] = r
        results[name] = round(statistics.median(times), 3)

    lineitem_changes = spark.read.text(text_dir).filter("value LIKE '%|lineitem|%'").count()
    out = {
        "metric": "sum of median wall time of q3_batch, replay_q3, stream_q3",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "rows": rows,
        "stream_lineitem_changes_per_sec": round(lineitem_changes / results["stream_q3"], 1),
        "stream_join_peak_state_rows": max(state_rows, default=0),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    retire_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
