"""The registered queries against DuckDB, and the pipeline stage by stage against brute force."""

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from check_oracle import duck, rows_of
from deltaq.llm import mixing, queries, toxicity
from deltaq.llm.common import materialize, table

from .test_near_dups import brute
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = E.queries()[name](spark, SF)
    rel = duck(SF).sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), f"test-{name}")
        out[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns and docs.dtypes == before.dtypes

    before, after = out["toxicity"]
    model = toxicity.fit(before, table(spark, SF, "labels"))
    clean = {r.doc_id for r in toxicity.grade(before, model).collect() if not r.toxic}
    assert {r.doc_id for r in after.collect()} == clean

    before, after = out["minhash_dedup"]
    groups = brute([(r.doc_id, r.text) for r in before.collect()], corpus_pipeline.DEDUP_PERCENT)
    assert sorted(r.doc_id for r in after.collect()) == sorted(
        i for i, (_, c) in groups.items() if c == i)

    before, after = out["pii_surrogates"]
    old, new = ({r.doc_id: r.text for r in t.collect()} for t in (before, after))
    assert set(old) == set(new)
    private = re.compile(r"[a-z]+\.\d+@\S+\.com|AKIA\w{16}|\+1 \(\d{3}\) \d{3}-\d{4}")
    for i, text in old.items():
        found = private.findall(text)
        assert all(x not in new[i] for x in found)
        assert found or re.search(r"\d", text) or text == new[i]

    before, after = out["mixing"]
    want = {r.doc_id: r.taken // r.size for r in mixing.op7_mixing(before).collect() if r.size}
    got = Counter(r.doc_id for r in after.collect())
    assert all(got.get(i, 0) == n for i, n in want.items())

    before, after = out["packing"]
    once = before.dropDuplicates(["doc_id"])
    pieces = corpus_pipeline.packing_stage(spark, once, SF).collect()
    check_packing(pieces, {r.doc_id: r.text for r in once.collect()})
    assert Counter(r.doc_id for r in after.filter("start = 0").collect()) == Counter(
        r.doc_id for r in before.collect())


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())
