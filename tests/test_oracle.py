"""Registered queries against their DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from check_oracle import duck, rows_of

SF = "/root/testdata/sf0.001"
FAST = ["q3_batch", "q3_sql", "typed_tables", "filter_segment", "item_revenue",
        "join_customer_orders", "synth_changelog", "synth_flip_deletes", "changelog_scan",
        "changelog_quarantine", "changelog_audit", "signed_changes", "replay_lineitem",
        "noop_deletes", "active_counts", "replay_q3", "replay_flipped_q3", "tbl_roundtrip",
        "result_csv_roundtrip", "reconcile_summary", "reconcile_preview", "stream_q3",
        "stream_running_revenue", "stream_normalize_lineitem", "drop_dead_groups"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle_or_is_rows_only():
    from deltaq.plans.catalog import ORACLE_SQL, QUERIES
    assert set(ORACLE_SQL) == set(QUERIES)
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)


def test_flipped_changelog_row_by_row(spark, con):
    """F3 in full: every line and its place (the registered query compares checksums)."""
    from deltaq.plans import changes as C
    from deltaq.plans import oracle as O
    rel = con.sql(f"WITH {O.TYPED_CTES.strip()},\n{O.shuffled_ctes()}\nSELECT seq, tbl, line FROM sh")
    df = C.flipped(spark, SF)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        rel.columns, rel.fetchall())


def test_flip_share_grows_with_the_changelog(spark):
    from pyspark.sql import functions as F

    from deltaq.operators import synth as S
    lines = spark.range(20_000).select(F.concat(F.lit("INSERT|t|"), F.col("id")).alias("line"))
    n = S.flip_deletes(lines, share=0.1).filter("line LIKE 'DELETE%'").count()
    assert 1800 < n < 2200


def test_a_changed_input_gives_a_new_answer_in_the_same_session(spark, scratch):
    """Nothing is kept between calls: rows appended to the input tables count at once."""
    import shutil

    from pyspark.sql import functions as F
    for t in ("customer", "orders", "lineitem"):
        os.makedirs(f"{scratch}/{t}.parquet")
        shutil.copy(f"{SF}/{t}.parquet", f"{scratch}/{t}.parquet/part-0.parquet")
    def both():
        return [E.queries()[q](spark, scratch).agg(F.sum("revenue")).first()[0]
                for q in ("incremental_revenue", "replay_q3")]
    before = both()
    again = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn(
        "l_extendedprice", F.col("l_extendedprice") + 100)
    again.write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    after = both()
    assert before[0] == before[1] and after[0] == after[1] and after[0] > before[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "o_orderdate", "o_shippriority", "revenue"]
    assert df.count() == 9


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
             "double": "DOUBLE", "boolean": "BOOLEAN"}
    oracle_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: types.get(t, t.upper()) for c, t in df.dtypes} == oracle_types
    assert rows_of(df.columns, got) == rows_of(cols, rel.fetchall())


# Flagship answers on the driver tables at sf0.001 (FIXTURES.md sections 2 and 3).
@pytest.mark.parametrize("name,rows,total", [("q3_batch", 9, "2289352.9819"),
                                             ("replay_q3", 8, "1949417.9039"),
                                             ("stream_q3", 8, "1949417.9039")])
def test_flagship_totals(spark, name, rows, total):
    from pyspark.sql import functions as F
    df = E.queries()[name](spark, SF)
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("s")).first()
    assert (got.n, str(got.s)) == (rows, total)
