"""Exact top-k search by inner product, pruned with multi-resolution segment statistics.

Components x become the integers floor(256 x).  A vector is cut into 1, 4 and 16 segments, and
each segment is described by its mean and standard deviation.  For a query q and a candidate c the
squared distance is at least ``sum w ((mean_q - mean_c)^2 + (dev_q - dev_c)^2)`` over segments of
width w, so the inner product (|q|^2 + |c|^2 - distance^2) / 2 is at most a bound that grows
tighter from coarse to fine.  In each cell a query first gets the exact scores of its most
promising candidates at the coarsest level; whatever is below the k-th of them at some level is
dropped there, and only survivors are computed exactly.  Pruning never drops a candidate that could
enter the result, so results are exact.

Work is cut into cells of at most ``QUERY_BLOCK`` queries and about ``CANDIDATE_BLOCK``
candidates; each task holds one cell at a time, and each cell hands on k rows a query.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part;
shorter vectors count as padded with zeros; ties go to the smaller vec_id; rows repeated with the
same vec_id and the same vector are one candidate, and a query never finds rows of its own vec_id;
null vec_ids take no part; fewer candidates than k give fewer rows; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deltaq.llm.common import materialize

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
SEGMENTS = (1, 4, 16)
SCALE = 256


def clean_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): distinct usable vectors, components as doubles."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x)
                              | (F.abs(x) == float("inf")))))


def as_matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(dim or 0, int(lengths.max()) if len(lengths) else 0)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), flat.dtype)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, columns] = flat
    return out


def _statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, int]:
    width = x.shape[1] // segments
    s = x.reshape(len(x), segments, width)
    return s.mean(axis=2), s.std(axis=2), width


def cell_top(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int,
             ) -> Iterator[tuple[int, int, int]]:
    """(query_id, vec_id, score) of each query's k best candidates in one cell, exactly."""
    dim = max(q.shape[1], c.shape[1])
    dim += -dim % max(SEGMENTS)
    q = np.pad(q, ((0, 0), (0, dim - q.shape[1])))
    c = np.pad(c, ((0, 0), (0, dim - c.shape[1])))
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    # Sums below 2^53 are exact in doubles; larger components are multiplied as integers.
    largest = max(np.abs(q).max(initial=0), np.abs(c).max(initial=0))
    exact = np.float64 if largest * largest * dim < 2.0 ** 53 else np.int64
    qe, ce = q.astype(exact), c.astype(exact)
    q2, c2 = (q * q).sum(1), (c * c).sum(1)
    levels = [(_statistics(q, s), _statistics(c, s)) for s in SEGMENTS]
    slack = 1e-6 * (q2.max(initial=0) + c2.max(initial=0)) + 1e-6

    def bound(i: int, rows: np.ndarray | slice, level: int) -> np.ndarray:
        (qm, qs, w), (cm, cs, _) = levels[level]
        low = w * (((cm[rows] - qm[i]) ** 2).sum(1) + ((cs[rows] - qs[i]) ** 2).sum(1))
        return (q2[i] + c2[rows] - low) / 2 + slack

    for i in range(len(q)):
        others = c_ids != q_ids[i]
        coarse = bound(i, slice(None), 0)
        coarse[~others] = -np.inf
        n = int(others.sum())
        if n == 0:
            continue
        take = min(n, 8 * k)
        seeds = np.argpartition(-coarse, take - 1)[:take]
        seeds = seeds[others[seeds]]
        scores = ce[seeds] @ qe[i]
        need = np.partition(scores, -min(k, len(scores)))[-min(k, len(scores))]
        need = need if len(scores) >= k else -np.inf
        alive = np.flatnonzero(coarse >= need)
        for level in range(1, len(SEGMENTS)):
            alive = alive[bound(i, alive, level) >= need]
        alive = alive[others[alive]]
        scores = ce[alive] @ qe[i]
        best = np.argsort(-scores, kind="stable")[:k]       # candidates are in vec_id order
        for j in best:
            yield int(q_ids[i]), int(c_ids[alive[j]]), int(scores[j])


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score).  Both inputs: vec_id, v (integers as longs or doubles)."""
    spark = vectors.sparkSession
    n_q, n_c = queries.count(), vectors.count()
    rows, columns = max(1, -(-n_q // QUERY_BLOCK)), max(1, -(-n_c // CANDIDATE_BLOCK))
    block = lambda side, n: F.pmod(F.xxhash64("vec_id", F.lit(side)), F.lit(n)).cast("int")
    # Cell (r, c): queries of block r against candidates of block c.
    q = (queries.select("vec_id", "v", block("q", rows).alias("_r"))
         .withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
         .withColumn("_query", F.lit(True)))
    c = (vectors.select("vec_id", "v", block("c", columns).alias("_c"))
         .withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
         .withColumn("_query", F.lit(False)))
    cells = (q.unionByName(c).repartition("_r", "_c").sortWithinPartitions("_r", "_c", "_query"))

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(parts):
            is_query = cell.column("_query").to_numpy(zero_copy_only=False)
            ids = cell.column("vec_id").to_numpy()
            v = as_matrix(cell.column("v").combine_chunks())
            found = list(cell_top(ids[is_query], v[is_query], ids[~is_query], v[~is_query], k))
            if found:
                query, vec, score = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(vec, pa.int64()),
                     pa.array(score, pa.int64())], names=["query_id", "vec_id", "score"])

    best = cells.mapInArrow(search, "query_id long, vec_id long, score long")
    # The same candidate may come from several rows; Spark keeps the first k before the shuffle.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table per cell, from rows in cell order."""
    held: list[pa.Table] = []
    key = None
    for part in parts:
        rows = pa.Table.from_batches([part])
        r, c = rows.column("_r").to_numpy(), rows.column("_c").to_numpy()
        change = np.flatnonzero((np.diff(r) != 0) | (np.diff(c) != 0)) + 1
        cuts = [0, *change.tolist(), len(r)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if key is not None and key != (r[a], c[a]):
                yield pa.concat_tables(held)
                held = []
            key = (r[a], c[a])
            held.append(rows.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


def op3_topk(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Queries: rows whose vec_id is divisible by ``every``, against all other rows."""
    v = materialize(clean_vectors(embeddings).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))
        .distinct(), "topk-vectors")
    return top_k(v, v.filter(F.col("vec_id") % every == 0), k)


OP3_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.v, v.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))
          ::BIGINT AS score
      FROM q JOIN v ON q.vec_id <> v.vec_id),
r AS (SELECT query_id, vec_id, score, (row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
