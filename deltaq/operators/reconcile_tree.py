"""Reconcile two large tables without moving the rows that are equal.

A tree of checksums over ranges of an integer key: a node is the key without its last bits.  Each
level sums a 64-bit hash of every row per node, expected rows counting plus and actual ones minus,
in one map-side aggregate over both sides; only nodes whose sums differ are opened, 4,096 ways, at
the next level.  What lies in the ranges that still differ at the end is compared in full by
``reconcile``; so what is shuffled as rows follows the number of differences, not the tables.

A level reads both sides once more (only the key range that holds differences: the bounds reach the
scan, so a table sorted on the key is read in part).  Hand in written tables, not long plans.

The list of open nodes is counted: up to ``MOST_NODES`` it is broadcast; beyond, the descent ends
and the rows of those nodes are compared in full through a shuffle join.  A hot key is one node of
one partial sum a task; where it differs, its rows are compared by all their columns.

Edge cases: null keys are a node of their own; rows that hold a null count as equal to rows with
nulls in the same columns; empty sides are ordinary.  Two ranges with equal counts and sums count as
equal (for rows of different content a chance of about one in 2^64).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reconcile import Reconciliation, reconcile
from .replay import stored

#: Bits of the key that one level opens.
FAN_BITS = 12
#: Rows a node may hold on average before opening it is worth a further level.
ENOUGH = 64
MOST_NODES = 100_000


@dataclass(frozen=True)
class TreeReconciliation:
    """Differences, compared row by row, and what lies in ranges that are equal."""
    apart: Reconciliation
    equal: DataFrame
    #: Rows in equal ranges; rows of both sides that were compared in full; levels of the tree.
    n_equal: int
    n_compared: int
    levels: int

    @property
    def missing(self) -> DataFrame:
        return self.apart.missing

    @property
    def extra(self) -> DataFrame:
        return self.apart.extra

    @property
    def matching(self) -> DataFrame:
        return self.equal.unionByName(self.apart.matching)

    def summary(self) -> DataFrame:
        return self.apart.summary(self.n_equal)


def _node(key: str, shift: int) -> Column:
    return F.shiftright(F.col(key).cast("long"), shift)


def _row_hash(columns: list[str]) -> Column:
    """Hash of a row; a null is a value of its own, at its own place."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _sums(both: DataFrame, columns: list[str], key: str, shift: int) -> DataFrame:
    """Rows of each side per node, and whether the sides' checksums differ."""
    sign = F.when(F.col("_exp"), F.lit(1)).otherwise(F.lit(-1))
    hashed = both.select(_node(key, shift).alias("_node"), "_exp", sign.alias("_sign"),
                         _row_hash(columns).alias("_h"))
    # In three pieces: sums of 2^41 rows fit a long.
    pieces = [F.col("_h").bitwiseAND(F.lit((1 << 22) - 1)),
              F.shiftrightunsigned("_h", 22).bitwiseAND(F.lit((1 << 21) - 1)),
              F.shiftrightunsigned("_h", 43)]
    grouped = hashed.groupBy("_node").agg(
        F.count_if(F.col("_exp")).alias("_n_exp"), F.count_if(~F.col("_exp")).alias("_n_act"),
        *[F.sum(F.col("_sign") * p).alias(f"_s{i}") for i, p in enumerate(pieces)])
    differs = F.col("_n_exp") != F.col("_n_act")
    for i in range(len(pieces)):
        differs = differs | (F.col(f"_s{i}") != 0)
    return grouped.select("_node", "_n_exp", "_n_act", differs.alias("_differs"))


@dataclass(frozen=True)
class _Open:
    """Nodes whose sides differ, at one level."""
    nodes: DataFrame
    shift: int
    count: int
    rows: int
    low: int | None
    high: int | None

    def _bounds(self, key: str) -> Column:
        """The key range around the nodes, in a form that scans can use."""
        k = F.col(key)
        if self.low is None:
            return k.isNull()
        return k.isNull() | k.between(self.low << self.shift,
                                      ((self.high + 1) << self.shift) - 1)

    def _listed(self) -> DataFrame:
        nodes = self.nodes.select(F.col("_node").alias("_open"))
        return F.broadcast(nodes) if self.count <= MOST_NODES else nodes

    def inside(self, rows: DataFrame, key: str) -> DataFrame:
        on = _node(key, self.shift).eqNullSafe(F.col("_open"))
        return rows.filter(self._bounds(key)).join(self._listed(), on, "left_semi")

    def outside(self, rows: DataFrame, key: str) -> DataFrame:
        on = _node(key, self.shift).eqNullSafe(F.col("_open"))
        return rows.join(self._listed(), on, "left_anti")


def _differing(level: DataFrame, shift: int) -> _Open:
    nodes = level.filter("_differs")
    n = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_n_exp") + F.col("_n_act")).alias("rows"),
                  F.min("_node").alias("low"), F.max("_node").alias("high")).first()
    return _Open(nodes, shift, n["n"], n["rows"] or 0, n["low"], n["high"])


def _once(rows: DataFrame, name: str) -> DataFrame:
    """The rows, each once.  Only those whose hash occurs again are compared and written; a table
    that holds none is handed on as it is."""
    hashed = _row_hash(rows.columns).alias("_h")
    again = stored(rows.select(hashed).groupBy("_h").agg(F.count(F.lit(1)).alias("_c"))
                   .filter("_c > 1").select("_h"), f"{name}_repeated")
    if not again.take(1):
        return rows
    marked = rows.select("*", hashed)
    repeated = stored(marked.join(again, "_h", "left_semi").drop("_h").distinct(), name)
    return marked.join(again, "_h", "left_anti").drop("_h").unionByName(repeated)


def reconcile_tree(expected: DataFrame, actual: DataFrame, key: str,
                   sets: bool = False) -> TreeReconciliation:
    """Compare two tables as sets of whole rows by checksums over ranges of the integer ``key``.

    ``sets`` says that neither side holds a row twice (the result of a GROUP BY, a table with a
    primary key); otherwise repeated rows are looked for first, at the price of a shuffle of one
    hash a row, and taken out where there are any.
    """
    columns = list(expected.columns)
    actual = actual.select(*columns)
    if not sets:
        expected, actual = _once(expected, "tree_expected"), _once(actual, "tree_actual")
    both = expected.select("*", F.lit(True).alias("_exp")).unionByName(
        actual.select("*", F.lit(False).alias("_exp")))
    ends = both.agg(F.min(key).cast("long").alias("low"), F.max(key).cast("long").alias("high")).first()
    span = 0 if ends["low"] is None else ends["high"] - ends["low"]
    shift, levels, n_expected, within = max(0, span.bit_length() - FAN_BITS), 0, None, both
    while True:
        level = stored(_sums(within, columns, key, shift), "tree_sums")
        levels += 1
        if n_expected is None:
            n_expected = level.agg(F.sum("_n_exp")).first()[0] or 0
        found = _differing(level, shift)
        if shift == 0 or found.rows <= ENOUGH * found.count or found.count > MOST_NODES:
            break
        within = found.inside(both, key)
        shift = max(0, shift - FAN_BITS)
    apart = reconcile(found.inside(expected, key), found.inside(actual, key))
    n_apart = found.nodes.agg(F.sum("_n_exp")).first()[0] or 0
    return TreeReconciliation(apart, found.outside(expected, key), n_expected - n_apart,
                              found.rows, levels)
