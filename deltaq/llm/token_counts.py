"""Exact length histogram: documents by encoded length, with suffix sums for any context limit.

Every task encodes its documents and hands on one row per length it saw, so what is shuffled grows
with the number of different lengths, not with the documents.  Suffix sums over the lengths then
answer, exactly and for every context limit at once: how many documents are at least that long,
their tokens, and the tokens left when every document is cut at the limit.

Edge cases: a null or empty text has length 0 and counts as a document; repeated rows count each;
an empty table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deltaq.llm.common import materialize
from deltaq.llm.encode import encoder, tokenizer_path

#: Lengths per bucket of the two-level suffix sums.
BUCKET = 1024


def length_histogram(docs: DataFrame, tokenizer: str | None = None,
                     text: str = "text") -> DataFrame:
    """(length, n_docs): documents by the number of ids their whole text encodes to."""
    path = tokenizer or tokenizer_path()

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for part in parts:
            seen.update(encoder(path).counts(part.column(0).to_pylist()))
        if seen:
            yield pa.RecordBatch.from_pydict(
                {"length": pa.array(list(seen), pa.int64()),
                 "n_docs": pa.array(list(seen.values()), pa.int64())})

    counted = docs.select(F.col(text).cast("string")).mapInArrow(
        count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length L: documents and tokens at L, at or above L, the share of documents no longer
    than L, and the tokens kept when every document is cut at L.  Two levels, so that no task
    holds all lengths: sums inside a bucket of lengths, plus the totals of the buckets above."""
    h = histogram.select(
        "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
        F.floor(F.col("length") / BUCKET).alias("_bucket"))
    above = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = h.groupBy("_bucket").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    buckets = buckets.select(        # one row per 1024 token lengths
        "_bucket", F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_tokens_above"))
    total = h.agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    inside = Window.partitionBy("_bucket").orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = h.select(
        "length", "n_docs", "n_tokens", "_bucket", F.sum("n_docs").over(inside).alias("_di"),
        F.sum("n_tokens").over(inside).alias("_ti")).join(buckets, "_bucket")
    out = out.crossJoin(F.broadcast(total))     # one row
    docs_ge = F.col("_di") + F.col("_docs_above")
    tokens_ge = F.col("_ti") + F.col("_tokens_above")
    return out.select(
        "length", "n_docs", "n_tokens", docs_ge.alias("docs_at_least"),
        tokens_ge.alias("tokens_at_least"),
        (F.col("_tokens") - tokens_ge + F.col("length") * docs_ge).alias("tokens_truncated"),
        ((F.col("_docs") - docs_ge + F.col("n_docs")) / F.col("_docs")).alias("cdf"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for given context limits: documents over the limit, tokens kept and tokens lost."""
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context long")
    # The histogram is tiny beside the corpus; the limits are a short list of the caller's.
    over = F.col("length") > F.col("context")
    return (sums.crossJoin(F.broadcast(wanted)).groupBy("context").agg(
        F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum("n_tokens").alias("tokens"),
        F.sum(F.least("length", "context") * F.col("n_docs")).alias("tokens_kept")))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least the given share of the documents does not exceed."""
    return sums.agg(*[
        F.min(F.when(F.col("cdf") >= q, F.col("length"))).alias(f"q{round(q * 1000)}")
        for q in shares])


def op1_token_counts(docs: DataFrame) -> DataFrame:
    # Written once: the sums read it three times, the corpus is encoded once.
    return suffix_sums(materialize(length_histogram(docs), "lengths"))
