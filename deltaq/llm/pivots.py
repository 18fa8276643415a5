"""Near-duplicate vectors by a pivot-permutation index.

A bounded sample of vectors, no two of them alike, serves as reference points (pivots).  Every
vector is described by its nearest pivots, and entered into an inverted list per pivot (per pair of
pivots where single lists would get long, which retrieves the same pairs).  Vectors that meet in a
list and share at least ``SHARED`` pivots are verified by their exact cosine.  A pair that meets in
several lists counts in the first of them only.

Copies of one vector are represented by their smallest vec_id throughout.  A long list is compared
in cells of two blocks, which hand on the number of links per vector and a spanning forest of the
cell, never all pairs, so a dense group costs multiplications but no rows.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and null
vec_ids, link with nothing (component_id is the own vec_id); rows repeated with vec_id and vector
count once; shorter vectors count as padded with zeros; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import materialize
from deltaq.llm.graph import connected_components, forest, runs, with_cells
from deltaq.llm.topk import as_matrix, clean_vectors

THRESHOLD = 0.95
NEAREST = 8             # pivots that describe a vector
SHARED = 2              # pivots a pair must share
MOST_PIVOTS = 4096      # also bounds the sample: 4 times as many vectors
LEAST_PIVOTS = 64
LIST = 1024             # vectors per list aimed at, and per block of a cell
APART = 0.8             # pivots are less alike than this


def choose_pivots(reps: DataFrame, n: int) -> np.ndarray:
    """Reference points: a keyed sample of bounded size, thinned until no two are alike."""
    wanted = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, n * NEAREST / LIST)))
    sample = reps.select("u").orderBy(F.xxhash64("rep", F.lit(3)), "rep").limit(
        4 * wanted).toArrow()
    x = as_matrix(sample.column("u").combine_chunks())
    kept: list[int] = []
    for i in range(len(x)):
        if len(kept) == wanted:
            break
        if not kept or (x[kept] @ x[i]).max() < APART:
            kept.append(i)
    return x[kept]


def describe(reps: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(rep, copies, u, near): ``near`` holds the numbers of the nearest pivots, ascending."""
    m = min(NEAREST, len(pivots))

    def nearest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows == 0:
                continue
            u = as_matrix(part.column("u"), pivots.shape[1])
            p = np.pad(pivots, ((0, 0), (0, u.shape[1] - pivots.shape[1])))
            by_order = np.argsort(-(u @ p.T), axis=1, kind="stable")[:, :m]
            near = np.sort(by_order, axis=1).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, near.size + 1, m), pa.int32()), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), part.column("copies"), part.column("u"), lists],
                names=["rep", "copies", "u", "near"])

    return reps.mapInArrow(nearest, "rep long, copies long, u array<double>, near array<int>")


def links(index: DataFrame, n: int, pivots: int, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (a, b, links): spanning links with b set, and counts of links per a with b null."""
    need = min(SHARED, pivots)
    pairs = need == 2 and n * NEAREST / max(1, pivots) > 8 * LIST
    if pairs:       # the same pairs as single lists with two shared pivots, in shorter lists
        keys = F.flatten(F.transform("near", lambda x: F.transform(
            F.filter("near", lambda y: y > x), lambda y: x.cast("long") * MOST_PIVOTS + y)))
    else:
        keys = F.transform("near", lambda x: x.cast("long"))
    rows = index.select("rep", "copies", "u", "near", F.explode(keys).alias("_key"))
    sizes = rows.groupBy("_key").agg(F.count("*").alias("_size")).filter("_size > 1")
    cells = with_cells(rows.join(sizes, "_key"), F.col("_size"), F.col("rep"), LIST)
    order = ["_key", "_i", "_j"]
    cells = (cells.select(*order, "_b", "rep", "copies", "u", "near").repartition(*order)
             .sortWithinPartitions(*order))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(parts, order):
            key, i, j = (cell.column(k)[0].as_py() for k in order)
            rep, copies = cell.column("rep").to_numpy(), cell.column("copies").to_numpy()
            u = as_matrix(cell.column("u").combine_chunks())
            near = as_matrix(cell.column("near").combine_chunks())
            b = cell.column("_b").to_numpy()
            left, right = np.flatnonzero(b == i), np.flatnonzero(b == j)
            x, y = np.nonzero(u[left] @ u[right].T >= threshold)
            x, y = left[x], right[y]
            if i == j:
                x, y = x[x < y], y[x < y]
            if len(x) == 0:
                continue
            first = np.concatenate([_first_key(near[x[s:s + 65536]], near[y[s:s + 65536]], need,
                                               pairs) for s in range(0, len(x), 65536)])
            x, y = x[first == key], y[first == key]
            if len(x) == 0:
                continue
            counts = (np.bincount(x, copies[y], len(rep)) + np.bincount(y, copies[x], len(rep)))
            some = np.flatnonzero(counts)
            child, root = forest(rep[x], rep[y])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([child, rep[some]])),
                 pa.array(np.concatenate([root, np.zeros(len(some), np.int64)]),
                          mask=np.arange(len(child) + len(some)) >= len(child)),
                 pa.array(np.concatenate([np.zeros(len(child), np.int64),
                                          counts[some].astype(np.int64)]))],
                names=["a", "b", "links"])

    return cells.mapInArrow(compare, "a long, b long, links long")


def _first_key(x: np.ndarray, y: np.ndarray, need: int, pairs: bool) -> np.ndarray:
    """The first list in which each pair meets; -1 where fewer than ``need`` pivots are shared."""
    shared = (x[:, :, None] == y[:, None, :]).any(axis=2)
    count = shared.sum(axis=1)
    rows = np.arange(len(x))
    one = np.argmax(shared, axis=1)
    key = x[rows, one].astype(np.int64)
    if pairs:
        shared[rows, one] = False
        key = key * MOST_PIVOTS + x[rows, np.argmax(shared, axis=1)]
    return np.where(count >= need, key, -1)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    v = clean_vectors(embeddings).distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    reps = (v.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
            .withColumn("_norm", norm).filter("_norm > 0"))
    reps = materialize(reps.select("rep", "copies", "v", F.transform(
        "v", lambda x: x / F.col("_norm")).alias("u")), "vector-classes")
    n = reps.count()
    member = v.join(reps.select("v", "rep", "copies"), "v").select("vec_id", "rep", "copies")
    if n:
        pivots = choose_pivots(reps, n)
        index = materialize(describe(reps.select("rep", "copies", "u"), pivots), "pivot-index")
        found = materialize(links(index, n, len(pivots), threshold), "vector-links")
        counts = found.filter("b is null").groupBy("a").agg(F.sum("links").alias("links"))
        component = connected_components(found.filter("b is not null").select("a", "b"))
        member = (member.join(counts.withColumnRenamed("a", "rep"), "rep", "left")
                  .join(component.withColumnRenamed("vertex", "rep"), "rep", "left"))
        member = member.select(
            "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("component", "rep").alias("_component"))
    else:
        member = member.select("vec_id", F.lit(0).cast("long").alias("_links"),
                               F.col("rep").alias("_component"))
    # An id repeated with different vectors has one row of links: the sum and the smallest.
    member = member.groupBy("vec_id").agg(F.sum("_links").alias("_links"),
                                          F.min("_component").alias("_component"))
    out = embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).join(
        member, "vec_id", "left")
    component = F.coalesce("_component", "vec_id")
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op5_embedding_dedup(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
      AND list_cosine_similarity(x.v, y.v) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT t.vec_id, coalesce(n_links, 0)::BIGINT AS n_links,
  coalesce(component_id, t.vec_id) AS component_id,
  coalesce(t.vec_id = coalesce(component_id, t.vec_id), true) AS kept
FROM embeddings t LEFT JOIN c ON c.a = t.vec_id LEFT JOIN n ON n.a = t.vec_id
"""
