"""A corpus pipeline over ``documents``: toxic documents go, one document of each group of
near-duplicates stays, personal data gets surrogates, sources are mixed to their targets, and the
mix is packed into sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet and reads again as the next one's ``docs``.  All but the
last return the columns of ``documents``.

Edge cases: every stage takes null, empty and very long texts, null ids, repeated rows, empty
tables and further columns, which are handed through; see each operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deltaq.llm import mixing, near_dups, packing, pii, toxicity
from deltaq.llm.common import materialize, ship, table

#: Near-duplicates of the stage share at least so much, in per cent, of their five-word shingles.
DEDUP_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labels of the documents at hand and leave out what is called toxic."""
    labels = table(ship(spark), sf_dir, "labels")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates."""
    ship(spark)
    return near_dups.without_near_duplicates(docs, DEDUP_PERCENT)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; every document stays."""
    return pii.replace_entities(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources come to their target weights."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    ship(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("minhash_dedup", dedup_stage),
    ("pii_surrogates", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Near-duplicate groups need transitive closure over set similarities, and packing a tokenizer:
#: no SQL.  tests/llm/test_pipeline.py holds the run against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
