"""The streaming path end to end: text files -> changes query -> join query -> snapshot."""

import os

import pytest

from deltaq.operators import parse as P
from deltaq.operators import replay as R
from deltaq.schemas import REFERENCE
from deltaq.sources.changelog import ARRIVAL, NAME, read_changelog
from deltaq.streaming import incremental as I

from .helpers import as_set, cust, item, order, python_replay


def write_file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_matches_replay_and_survives_restart(spark, scratch):
    text = os.path.join(scratch, "in")
    first = [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1),
             item("INSERT", 10, 1), "garbage line", ""]
    second = [order("INSERT", 11, 1), item("INSERT", 11, 1), item("DELETE", 10, 1),
              cust("INSERT", 2, seg="BUILDING"), order("INSERT", 12, 2), item("INSERT", 12, 1)]
    third = [item("INSERT", 10, 1, price="50.00"), cust("DELETE", 2), order("DELETE", 11, 1),
             order("INSERT", 11, 1, date="1995-02-01")]
    paths = I.Paths(os.path.join(scratch, "work"))
    write_file(text, "part-0001.txt", first)
    write_file(text, "part-0002.txt", second)
    I.run_changes(spark, text, paths, REFERENCE, files_per_trigger=1)
    # the job stops; more changes arrive; it resumes from its checkpoint
    write_file(text, "part-0003.txt", third)
    got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE, files_per_trigger=1))
    expected = python_replay([l for l in first + second + third if l.count("|") > 2])
    assert got == expected
    assert len(expected) == 2
    bad = spark.read.parquet(paths.of("bronze")).filter("reason IS NOT NULL").count()
    assert bad == 2
    audit = {(r.tbl, r.op, r.status): r.n for r in I.audit(spark, paths, REFERENCE).collect()}
    assert audit[(None, "GARBAGE LINE", "too_few_parts")] == 1
    assert audit[(None, "", "blank")] == 1
    assert audit[("lineitem", "INSERT", "accepted")] == 5


def test_late_file_is_ordered_by_its_number_or_by_arrival(spark, scratch):
    base = [cust("INSERT", 1), order("INSERT", 10, 1)]
    for how, expected in ((NAME, 0), (ARRIVAL, 1)):
        text = os.path.join(scratch, how, "in")
        paths = I.Paths(os.path.join(scratch, how, "work"))
        # the DELETE (file 100000) is processed before the INSERT of the item (file 99999) arrives
        write_file(text, "part-100000.txt", base + [item("DELETE", 10, 1)])
        I.run_changes(spark, text, paths, REFERENCE, files_per_trigger=1, order=how)
        write_file(text, "part-99999.txt", [item("INSERT", 10, 1)])
        got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE, files_per_trigger=1, order=how))
        assert len(got) == expected


def test_arrival_order_takes_any_file_names(spark, scratch):
    text = os.path.join(scratch, "in")
    paths = I.Paths(os.path.join(scratch, "work"))
    files = {"zeta": [cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1)],
             "alpha": [item("DELETE", 10, 1)], "mid": [item("INSERT", 10, 1, price="50.00")]}
    for name, lines in files.items():
        write_file(text, name, lines)
        I.run_changes(spark, text, paths, REFERENCE, order=ARRIVAL)
    got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE, order=ARRIVAL))
    assert got == python_replay([x for lines in files.values() for x in lines])
    assert {g[3] for g in got} == {"45.0000"}


def test_part_numbers_order_as_numbers_in_the_batch_reader(spark, scratch):
    """Past 100,000 part files: the DELETE in part-100000 comes after the INSERT in part-99999."""
    text = os.path.join(scratch, "in")
    write_file(text, "part-99999-x.txt", [cust("INSERT", 1), order("INSERT", 10, 1),
                                          item("INSERT", 10, 1)])
    write_file(text, "part-100000-x.txt", [item("DELETE", 10, 1), item("INSERT", 10, 2)])
    lines = read_changelog(spark, text)
    assert dict(lines.dtypes)["seq"] == "decimal(38,0)"
    ordered = [r.value.split("|")[:2] for r in lines.orderBy("seq").collect()]
    assert [x[0] + x[1] for x in ordered] == ["INSERTcustomer", "INSERTorders", "INSERTlineitem",
                                              "DELETElineitem", "INSERTlineitem"]
    routes = P.route_all(P.parse(lines, REFERENCE), REFERENCE)
    live = R.live(routes["lineitem"], REFERENCE["lineitem"].key)
    assert [r.l_linenumber for r in live.collect()] == [2]
    plan = R.last_delete(routes["lineitem"], ["l_orderkey"])._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_name_without_a_number_is_an_error_of_a_stream_in_name_order(spark, scratch):
    write_file(os.path.join(scratch, "in"), "abc.txt", [cust("INSERT", 1)])
    with pytest.raises(Exception, match="no number"):
        I.run_changes(spark, os.path.join(scratch, "in"),
                      I.Paths(os.path.join(scratch, "work")), REFERENCE)


@pytest.mark.parametrize("markers", ["true", "false"])
def test_join_that_drains_before_a_failed_batch_is_retried(spark, scratch, markers):
    """A batch fails after its writes, the join reads them, then the batch is retried: its input
    must count once, with and without success markers."""
    text = os.path.join(scratch, "in")
    paths = I.Paths(os.path.join(scratch, "work"))
    write_file(text, "part-0000.txt", [cust("INSERT", 1), order("INSERT", 10, 1),
                                       item("INSERT", 10, 1)])
    conf = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    old = spark.conf.get(conf, None)
    spark.conf.set(conf, markers)

    def crash(fn):
        def run(df, batch_id):
            fn(df, batch_id)
            raise RuntimeError("lost after the batch wrote its output")
        return run

    try:
        for _ in range(2):
            q = I.start_changes(spark, text, paths, REFERENCE, wrap=crash)
            with pytest.raises(Exception):
                q.awaitTermination()
            I.drained(I.start_join(spark, paths))
        got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE))
    finally:
        spark.conf.unset(conf) if old is None else spark.conf.set(conf, old)
    assert {g[3] for g in got} == {"90.0000"}


def test_a_batch_that_fails_between_its_outputs(spark, scratch, monkeypatch):
    """The retry publishes what is missing and leaves alone what is in place."""
    text = os.path.join(scratch, "in")
    paths = I.Paths(os.path.join(scratch, "work"))
    write_file(text, "part-0000.txt", [cust("INSERT", 1), order("INSERT", 10, 1),
                                       item("INSERT", 10, 1)])
    publish, calls = I.storage.publish, []

    def second_fails(df, staging, final):
        calls.append(final)
        if len(calls) == 2:
            raise RuntimeError("lost before the rename")
        return publish(df, staging, final)

    monkeypatch.setattr(I.storage, "publish", second_fails)
    q = I.start_changes(spark, text, paths, REFERENCE)
    with pytest.raises(Exception):
        q.awaitTermination()
    I.drained(I.start_join(spark, paths))
    monkeypatch.setattr(I.storage, "publish", publish)
    got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE))
    assert {g[3] for g in got} == {"90.0000"}


def test_folded_delta_log_gives_the_same_snapshot(spark, scratch):
    text = os.path.join(scratch, "in")
    paths = I.Paths(os.path.join(scratch, "work"))
    files = [[cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1)],
             [item("DELETE", 10, 1), order("INSERT", 11, 1), item("INSERT", 11, 1)],
             [item("INSERT", 10, 3, price="10.00"), cust("DELETE", 1)], [cust("INSERT", 1)]]
    for i, lines in enumerate(files):
        write_file(text, f"part-{i:04d}.txt", lines)
        got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE))
        I.fold_delta(spark, paths.delta, i)
        assert got == as_set(I.snapshot(spark, paths.delta))
        assert got == python_replay([x for f in files[:i + 1] for x in f])
    assert I.last_fold(spark, paths.delta) == 3


def test_the_number_of_salts_is_kept_with_the_checkpoint(spark, scratch):
    paths = I.Paths(os.path.join(scratch, "work"))
    assert I.join_salts(spark, paths, 4) == 4
    assert I.join_salts(spark, paths) == 4
    with pytest.raises(ValueError):
        I.join_salts(spark, paths, 8)


def test_a_small_batch_reads_few_folders_of_the_log(spark, scratch):
    """What a batch reads follows its keys: of the compacted log, only their buckets."""
    from pyspark.sql import functions as F

    from deltaq.streaming import normalise as N
    log = os.path.join(scratch, "log")
    rows = spark.range(5000).select(F.col("id").alias("seq"), F.lit("INSERT").alias("op"),
                                    F.col("id").alias("k"), F.lit(0).alias("b"))
    late = spark.createDataFrame([(9000, "DELETE", 17, 1)], "seq bigint, op string, k bigint, b int")

    def read(batches):
        return rows.unionByName(late).filter(F.col("b").isin(batches))

    N.normalise(spark, read, 0, log, ["k"], every=1).collect()
    assert len(os.listdir(os.path.join(log, "compact", "upto=0"))) > N.BUCKETS / 2
    folders = []
    real = N.stored

    def spy(df, name, path=None):
        if name == "touched_rows":
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            folders.extend(line for line in plan.splitlines() if "PartitionFilters" in line
                           and "kb" in line)
        return real(df, name, path)

    N.stored = spy
    try:
        got = N.normalise(spark, read, 1, log, ["k"], every=1).collect()
    finally:
        N.stored = real
    assert [(r.k, r.w) for r in got] == [(17, -1)]
    assert folders           # the one bucket of key 17 is a partition filter of the log's scan


def test_batch_that_fails_after_writing_is_redone_without_double_counting(spark, scratch):
    text = os.path.join(scratch, "in")
    paths = I.Paths(os.path.join(scratch, "work"))
    files = [[cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1)],
             [item("INSERT", 10, 2), order("INSERT", 11, 1), item("INSERT", 11, 1)],
             [item("DELETE", 10, 1)]]
    for i, lines in enumerate(files):
        write_file(text, f"part-{i:04d}.txt", lines)

    def crash_on_second(fn):
        def run(df, batch_id):
            fn(df, batch_id)
            if batch_id == 1:
                raise RuntimeError("executor lost after the batch wrote its output")
        return run

    q = I.start_changes(spark, text, paths, REFERENCE, files_per_trigger=1,
                        wrap=crash_on_second)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    got = as_set(I.run_q3(spark, text, paths, layout=REFERENCE, files_per_trigger=1))
    assert got == python_replay([l for f in files for l in f])
    assert {g[3] for g in got} == {"90.0000"}


def test_both_queries_running_side_by_side(spark, scratch):
    text = os.path.join(scratch, "in")
    paths = I.Paths(os.path.join(scratch, "work"))
    files = [[cust("INSERT", 1), order("INSERT", 10, 1), item("INSERT", 10, 1)],
             [item("INSERT", 10, 2), cust("DELETE", 1)],
             [cust("INSERT", 1), item("INSERT", 10, 3, price="10.00")]]
    write_file(text, "part-0000.txt", files[0])
    join = I.start_join(spark, paths, available_now=False, processing_time="1 second")  # first
    changes = I.start_changes(spark, text, paths, REFERENCE, files_per_trigger=1,
                              available_now=False, processing_time="1 second")
    join.processAllAvailable()
    changes.processAllAvailable()
    try:
        for i, lines in enumerate(files[1:], start=1):
            write_file(text, f"part-{i:04d}.txt", lines)
            changes.processAllAvailable()
            join.processAllAvailable()
    finally:
        changes.stop()
        join.stop()
    got = as_set(I.snapshot(spark, paths.delta))
    assert got == python_replay([l for f in files for l in f])
