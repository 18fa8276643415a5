"""Connected components of links, and the cells in which blocks of a long list are compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import is_empty, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of ``edges`` (a long, b long): the smallest vertex that
    links reach.  Each round every vertex joins its smallest neighbour (a partial minimum, so a
    hub's links meet in one row per task), joined vertices become one, and links inside it go; the
    rounds end when no link is left, after about as many as the logarithm of the longest path."""
    spark = edges.sparkSession
    left = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .filter("a <> b").distinct(), "links")
    labels = spark.createDataFrame([], "vertex long, component long")
    first = True
    while not is_empty(left):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy("a").agg(F.min("b").alias("_m")).select(
            F.col("a").alias("v"), F.least("a", "_m").alias("p")), "parents")
        above = parent.select(F.col("v").alias("p"), F.col("p").alias("p2"))
        parent = materialize(parent.join(above, "p").select("v", F.col("p2").alias("p")),
                             "grandparents")
        if first:
            labels = parent.select(F.col("v").alias("vertex"), F.col("p").alias("component"))
        else:
            labels = materialize(labels.join(parent, F.col("component") == F.col("v"), "left")
                                 .select("vertex", F.coalesce("p", "component").alias("component")),
                                 "labels")
        pa_ = parent.select(F.col("v").alias("a"), F.col("p").alias("_a"))
        pb = parent.select(F.col("v").alias("b"), F.col("p").alias("_b"))
        left = materialize(left.join(pa_, "a").join(pb, "b").filter("_a <> _b").select(
            F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
        first = False
    return labels


def with_cells(rows: DataFrame, size: Column, row_id: Column, block: int,
               united: Column | None = None, n_united: Column | None = None) -> DataFrame:
    """Deal the rows of a list over blocks of about ``block`` rows, and copy each row to every cell
    (_i, _j), _i <= _j, its block ``_b`` takes part in.  A short list is one cell; a long one is
    split so that no task ever holds more than two blocks.  Rows of a long list that are ``united``
    (``n_united`` of them) need not meet each other: they get blocks of their own, which take part
    in cells with the other blocks only."""
    hashed = F.xxhash64(row_id, F.lit(5))
    if united is None:
        dealt = rows.withColumn("_n", F.greatest(F.lit(1), F.ceil(size / block)).cast("int"))
        dealt = dealt.withColumns({"_b": F.pmod(hashed, F.col("_n")).cast("int"), "_m": F.col("_n")})
    else:
        def count(x: Column) -> Column:
            return F.greatest(F.lit(1), F.ceil(x / block)).cast("int")

        short = size <= block
        dealt = rows.withColumn("_n", F.when(short, 1).otherwise(count(size - n_united)))
        dealt = dealt.withColumn("_u", F.when(short, 0).otherwise(count(n_united)))
        own = F.col("_n") + F.pmod(hashed, F.greatest(F.lit(1), F.col("_u"))).cast("int")
        dealt = dealt.withColumns({
            "_b": F.when(united & ~short, own).otherwise(F.pmod(hashed, F.col("_n")).cast("int")),
            "_m": F.when(united, F.col("_n")).otherwise(F.col("_n") + F.col("_u"))}).drop("_u")
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    return dealt.withColumns({"_i": F.least("_b", "_o"), "_j": F.greatest("_b", "_o")}).drop(
        "_n", "_m", "_o")


def runs(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one key after another, from rows ordered by integer key columns."""
    held: list[pa.Table] = []
    last = None
    for part in parts:
        if part.num_rows == 0:
            continue
        rows = pa.Table.from_batches([part])
        columns = [rows.column(k).to_numpy() for k in keys]
        change = np.zeros(len(rows) - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(rows)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            last = key
            held.append(rows.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a cell as (vertex, smallest vertex of its part), one per vertex but the roots."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[:len(a)], flat[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(names)))
    return names[child], names[root[child]]
