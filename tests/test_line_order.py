"""A1/A5: the order of lines follows all numbers of the files' paths, or reading fails."""

import os

import pytest

from deltaq.operators import parse as P
from deltaq.operators import replay as R
from deltaq.plans.q3 import q3
from deltaq.schemas import REFERENCE
from deltaq.sources import changelog as C
from deltaq.streaming import incremental as I

from .helpers import as_set, cust, item, order, python_replay


def write(folder, name, lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("".join(x + "\n" for x in lines))


STEPS = [[cust("DELETE", 1), order("INSERT", 10, 1), item("INSERT", 10, 2)],
         [cust("INSERT", 1), item("DELETE", 10, 2)],
         [cust("INSERT", 2), item("INSERT", 10, 1), item("INSERT", 10, 2, price="7.00")],
         [cust("DELETE", 2), item("DELETE", 10, 1)]]
EVERY = [x for step in STEPS for x in step]

NAMES = {
    "dated": ["2026-12-03-001.txt", "2026-12-03-002.txt", "2026-12-03-010.txt", "2026-12-04-001.txt"],
    "stamped": ["20261203014945.txt", "20261203014946.txt", "20261203115946.txt",
                "20270101000000.txt"],
    "two numbers": ["log-2-9.txt", "log-2-10.txt", "log-10-1.txt", "log-10-2.txt"],
    "folders": ["day=9/part-1.txt", "day=9/part-2.txt", "day=10/part-0.txt", "day=10/part-1.txt"],
    "text": ["a.txt", "b.txt", "c.txt", "d1.txt"],
    "wide": [f"{10 ** 30 + i}.txt" for i in range(4)],
}
NEEDS = {"dated": (4, 2, 2, 3), "stamped": (14,), "two numbers": (8, 8), "folders": (8, 8)}


def replayed(spark, lines):
    routes = P.route_all(P.parse(lines, REFERENCE), REFERENCE)
    live = {t: R.live(df, REFERENCE[t].key) for t, df in routes.items()}
    return live, as_set(q3(live["customer"], live["orders"], live["lineitem"]))


@pytest.mark.parametrize("kind", NAMES)
def test_a_folder_is_read_in_natural_order(spark, scratch, kind):
    for name, lines in reversed(list(zip(NAMES[kind], STEPS))):
        write(scratch, name, lines)
    lines = C.read_changelog(spark, scratch)
    assert dict(lines.dtypes) == {"seq": "decimal(38,0)", "value": "string"}
    rows = lines.orderBy("seq").collect()
    assert [r.value for r in rows] == EVERY and len({r.seq for r in rows}) == len(rows)
    live, got = replayed(spark, lines)
    assert got == python_replay(EVERY) and {g[3] for g in got} == {"6.3000"}
    assert [r.c_custkey for r in live["customer"].collect()] == [1]


@pytest.mark.parametrize("kind", NEEDS)
@pytest.mark.parametrize("how", [C.NAME, C.ARRIVAL])
def test_a_stream_gives_the_sequential_answer(spark, scratch, kind, how):
    text, paths = os.path.join(scratch, "in"), I.Paths(os.path.join(scratch, "work"))
    for name, lines in zip(NAMES[kind], STEPS):
        write(text, name, lines)
    got = I.run_q3(spark, text, paths, layout=REFERENCE, files_per_trigger=None, order=how,
                   widths=NEEDS[kind])
    assert as_set(got) == python_replay(EVERY)


def test_late_dated_file_takes_its_place_in_a_stream(spark, scratch):
    text, paths = os.path.join(scratch, "in"), I.Paths(os.path.join(scratch, "work"))
    for i in (3, 0, 2, 1):
        write(text, NAMES["dated"][i], STEPS[i])
        I.run_changes(spark, text, paths, REFERENCE, widths=NEEDS["dated"])
    got = I.run_q3(spark, text, paths, layout=REFERENCE, widths=NEEDS["dated"])
    assert as_set(got) == python_replay(EVERY)


def test_appended_part_files_come_after_what_is_there(spark, scratch):
    path = os.path.join(scratch, "log")
    at = 0
    for step in STEPS:
        rows = [(at + i, x) for i, x in enumerate(step)]
        at += len(step)
        C.write_changelog(spark.createDataFrame(rows, "seq bigint, line string"), path,
                          partitions=2, mode="append")
    assert sorted(x for x in os.listdir(path) if x.startswith("batch")) == [
        f"batch={i}" for i in range(4)]
    lines = C.read_changelog(spark, path)
    assert [r.value for r in lines.orderBy("seq").collect()] == EVERY
    assert replayed(spark, lines)[1] == python_replay(EVERY)
    paths = I.Paths(os.path.join(scratch, "work"))
    assert as_set(I.run_q3(spark, path, paths, layout=REFERENCE)) == python_replay(EVERY)


UUID = "-0a1b2c3d-1111-2222-3333-0123456789ab-c000.txt"
OTHER = "-ffffffff-1111-2222-3333-0123456789ab-c000.txt"


def test_names_that_tie_are_an_error(spark, scratch):
    for a, b in (("part-00000" + UUID, "part-00000" + OTHER), ("f1.txt", "f01.txt")):
        folder = os.path.join(scratch, a[:4])
        write(folder, a, STEPS[0])
        write(folder, b, STEPS[1])
        with pytest.raises(C.OrderError, match="orders"):
            C.read_changelog(spark, folder)


def test_a_stream_fails_on_a_place_taken_by_an_earlier_batch(spark, scratch):
    text, paths = os.path.join(scratch, "in"), I.Paths(os.path.join(scratch, "work"))
    write(text, "part-00000" + UUID, STEPS[0])
    I.run_changes(spark, text, paths, REFERENCE)
    write(text, "part-00000" + OTHER, STEPS[1])
    with pytest.raises(Exception, match="nothing in their names orders"):
        I.run_changes(spark, text, paths, REFERENCE)


def test_places_of_a_stream_in_name_order():
    assert C.fixed_place("part-7") == 7 * 10 ** 8
    assert C.fixed_place("2026-12-03-010.txt", (4, 2, 2, 3)) == 20261203010
    assert C.fixed_place("log-2-9") < C.fixed_place("log-2-10") < C.fixed_place("log-10-1")
    own = ["part-00007" + UUID, "part-00007" + UUID.replace("c000", "c001"), "part-100000" + UUID,
           "batch=0/part-00000" + UUID, "batch=0/part-00001" + UUID, "batch=10/part-00000" + UUID]
    assert sorted(reversed(own), key=C.fixed_place) == own
    assert C.fixed_place(own[0]) == 7 * 10 ** 4 and C.fixed_place(own[3]) == 10 ** 11
    for bad, widths in (("abc", (8, 8)), ("2026-12-03", (8, 8)), ("123456789", (8, 8)),
                        ("1-2-3", (8, 8))):
        with pytest.raises(C.OrderError):
            C.fixed_place(bad, widths)
    with pytest.raises(ValueError):
        C.fixed_place("1", (10, 10))


def test_seq_has_the_batch_the_place_the_block_and_the_row(spark):
    row = spark.range(1).select(*[C.line_order(
        *[F_lit(x) for x in (12, 34, 56)], batch_id=b).alias(f"b{b}") for b in (None, 7)]).first()
    assert int(row[0]) == 12 * 10 ** 22 + 34 * 10 ** 10 + 56
    assert int(row[1]) == int(row[0]) + 7 * 10 ** 30


def F_lit(x):
    from pyspark.sql import functions as F
    return F.lit(x).cast("bigint")
