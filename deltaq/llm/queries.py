"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from deltaq.llm import (
    certified_packing, licenses, mixing, near_dups, packing, periodic, pii, pivots, spelling,
    token_counts, token_files, topk, toxicity)
from deltaq.llm.common import ship, table


def _over(name: str, operator: Callable[[DataFrame], DataFrame],
          ) -> Callable[[SparkSession, str], DataFrame]:
    """A query that applies an operator to one whole table."""
    return lambda spark, sf_dir: operator(table(ship(spark), sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": _over("documents", token_counts.op1_token_counts),
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_topk": _over("embeddings", topk.op3_topk),
    "op4_pii_surrogates": _over("documents", pii.op4_pii_surrogates),
    "op5_embedding_dedup": _over("embeddings", pivots.op5_embedding_dedup),
    "op6_minhash_dedup": _over("documents", near_dups.op6_minhash_dedup),
    "op7_mixing": _over("documents", mixing.op7_mixing),
    "op8_licenses": _over("documents", licenses.op8_licenses),
    "op9_token_files": _over("documents", token_files.op9_token_files),
    "op10_packing": _over("documents", packing.op10_packing),
    "op11_periodic_runs": _over("documents", periodic.op11_periodic_runs),
    "op12_spelling_groups": _over("documents", spelling.op12_spelling_groups),
    "op13_certified_packing": _over("documents", certified_packing.op13_certified_packing),
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_topk": topk.OP3_SQL,
    "op5_embedding_dedup": pivots.OP5_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op8_licenses": licenses.OP8_SQL,
}
