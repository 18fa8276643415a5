"""Reconcile two result sets.

Both sides are compared as sets of whole rows (E1).  One full outer join on all columns (with
null-safe equality) after ``distinct`` gives every figure at once: rows only expected (E2), only
actual (E3), in both (E4), and the one-row summary with the accuracy figure (E5, E7).  The
distinct and the join share one hash partitioning on all columns, so the compare costs one
shuffle per side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PREVIEW_ALL = 10
PREVIEW_FIRST = 5


@dataclass(frozen=True)
class Reconciliation:
    columns: tuple[str, ...]
    joined: DataFrame

    def _side(self, present: str, absent: str, prefix: str) -> DataFrame:
        rows = self.joined.filter(F.col(present).isNotNull() & F.col(absent).isNull())
        return rows.select(*[F.col(f"{prefix}{c}").alias(c) for c in self.columns])

    @property
    def missing(self) -> DataFrame:
        """Expected but not produced."""
        return self._side("_in_exp", "_in_act", "_e_")

    @property
    def extra(self) -> DataFrame:
        """Produced but not expected."""
        return self._side("_in_act", "_in_exp", "_a_")

    @property
    def matching(self) -> DataFrame:
        """In both."""
        rows = self.joined.filter(F.col("_in_exp").isNotNull() & F.col("_in_act").isNotNull())
        return rows.select(*[F.col(f"_e_{c}").alias(c) for c in self.columns])

    def summary(self, equal: int = 0) -> DataFrame:
        """E5 + E7: counts, accuracy = matching * 100 / larger side, identical flag; ``equal`` rows
        known to be in both sides count in."""
        agg = self.joined.agg(
            F.count("_in_exp").alias("n_expected"), F.count("_in_act").alias("n_actual"),
            F.count(F.when(F.col("_in_exp").isNotNull() & F.col("_in_act").isNotNull(), 1))
            .alias("n_matching"))
        if equal:
            agg = agg.select(*[(F.col(c) + F.lit(equal)).alias(c) for c in agg.columns])
        n_e, n_a, m = F.col("n_expected"), F.col("n_actual"), F.col("n_matching")
        accuracy = (F.when((n_e > 0) & (n_a > 0),
                           m.cast("double") * F.lit(100.0) / F.greatest(n_e, n_a).cast("double"))
                    .when((n_e > 0) | (n_a > 0), F.lit(0.0)))
        return agg.select(n_e, n_a, m, (n_e - m).alias("n_missing"), (n_a - m).alias("n_extra"),
                          accuracy.alias("accuracy"),
                          ((n_e == m) & (n_a == m)).alias("identical"))


def reconcile(expected: DataFrame, actual: DataFrame) -> Reconciliation:
    cols = tuple(expected.columns)
    exp = expected.select(*[F.col(c).alias(f"_e_{c}") for c in cols]).distinct() \
        .withColumn("_in_exp", F.lit(True))
    act = actual.select(*[F.col(c).alias(f"_a_{c}") for c in cols]).distinct() \
        .withColumn("_in_act", F.lit(True))
    cond = None
    for c in cols:
        eq = F.col(f"_e_{c}").eqNullSafe(F.col(f"_a_{c}"))
        cond = eq if cond is None else cond & eq
    return Reconciliation(cols, exp.join(act, cond, "full"))


def preview(rows: DataFrame, side: str, show_all: int = PREVIEW_ALL,
            first: int = PREVIEW_FIRST) -> DataFrame:
    """All rows when there are at most ``show_all``, else the first ``first`` in row order,
    with the number left out.  The limit is the feature: a bounded top-k, no row collected."""
    cols = rows.columns
    total = rows.agg(F.count(F.lit(1))).scalar()
    top = rows.orderBy(*cols).limit(show_all)
    # row_number over at most ``show_all`` rows
    ranked = top.withColumn("rn", F.row_number().over(Window.orderBy(*cols)).cast("bigint"))
    shown = F.when(total <= F.lit(show_all), total).otherwise(F.lit(first))
    return ranked.filter(F.col("rn") <= shown).select(
        F.lit(side).alias("side"), "rn", *cols, (total - shown).alias("remaining"))
