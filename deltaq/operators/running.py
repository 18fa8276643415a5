"""Running totals after every change (D4), without a group meeting in one task.

``running_sums`` gives each row the sums of some whole-number columns over the rows of its group up
to itself, in order, and may start anew after marked rows.  A window per group would put a hot group
into one task; here it is a prefix sum in three steps:

    range partition by (group, order)      a hot group spans neighbouring tasks
    scan of each task                      sums since the group's (or mark's) start in the task
    carry over                             one row per task: the sum still open at its end; what is
                                           open before a task is added to its first rows

``line_item_effects`` uses it twice: sums that start anew after each DELETE tell what a DELETE
removes (all live copies of its key), and sums per order of those effects are the running revenue.

Edge cases: rows with a null group belong to no group and are left out; equal orders are taken in
any order, so give a total order; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.expressions import revenue, shipped_after
from ..params import DEFAULT, Q3Params
from .replay import stored

#: Sums are exact: each value is split at this bit, and both halves are added as 64-bit integers.
_LOW_BITS = 32
TOTAL = T.DecimalType(38, 0)


def _halves(column: str) -> list[str]:
    return [f"_hi_{column}", f"_lo_{column}"]


def _whole(column: str) -> Column:
    high, low = (F.col(c).cast(TOTAL) for c in _halves(column))
    return (high * F.lit(1 << _LOW_BITS).cast("decimal(10,0)") + low).cast(TOTAL)


def running_sums(rows: DataFrame, group: Sequence[str], order: Sequence[str],
                 values: Sequence[str], restart: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """``rows`` with ``sum_<v>`` (decimal(38,0)) for each bigint column v: the sum over the rows of
    the same group up to and with this one, by ``order``; where the boolean column ``restart`` is
    true, the next row starts a new sum."""
    spark = rows.sparkSession
    n = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    group, order, values = list(group), list(order), list(values)
    sums = [h for v in values for h in _halves(v)]
    known = F.lit(True)
    for g in group:
        known = known & F.col(g).isNotNull()
    ranged = (rows.filter(known).repartitionByRange(n, *[F.col(c) for c in group + order])
              .sortWithinPartitions(*group, *order))
    schema = T.StructType(
        ranged.schema.fields + [T.StructField(c, T.LongType()) for c in sums]
        + [T.StructField("_task", T.IntegerType()), T.StructField("_first", T.BooleanType()),
           T.StructField("_kind", T.StringType()), T.StructField("_closed", T.BooleanType())])
    names = schema.fieldNames()

    def scan(batches):
        """Rows with their sums inside the task; then the task's first and last row, the last with
        what is still open and whether a sum ended before it in the task."""
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        last, open_sums, closed, head = None, np.zeros(len(sums), np.int64), False, None

        def extended(table, totals, first, kind, end=None):
            size = len(table)
            for c, x in zip(sums, totals.T):
                table = table.append_column(c, pa.array(x, pa.int64()))
            for c, x in (("_task", pa.array(np.full(size, task, np.int32))),
                         ("_first", pa.array(first, pa.bool_())),
                         ("_kind", pa.array([kind] * size)),
                         ("_closed", pa.array([end] * size, pa.bool_()))):
                table = table.append_column(c, x)
            return table.select(names).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            size = len(table)
            both = table if last is None else pa.concat_tables([last, table])
            new = np.zeros(len(both), bool)
            for g in group:
                column = both.column(g).combine_chunks()
                new[1:] |= ~pc.equal(column.slice(1), column.slice(0, len(both) - 1)).to_numpy(
                    zero_copy_only=False)
            if restart:
                marks = both.column(restart).to_numpy(zero_copy_only=False).astype(bool)
                new[1:] |= marks[:-1]
            new = new[len(both) - size:]
            if last is None:
                head = table.slice(0, 1)
                yield from extended(head, np.zeros((1, len(sums)), np.int64), [False], "head")
            own = np.empty((size, len(sums)), np.int64)
            for k, v in enumerate(values):
                x = table.column(v).to_numpy()
                own[:, 2 * k], own[:, 2 * k + 1] = x >> _LOW_BITS, x & ((1 << _LOW_BITS) - 1)
            totals = np.cumsum(own, 0)
            # What had been added before the start of each row's sum.
            at = np.maximum.accumulate(np.where(new, np.arange(size), -1))
            before = np.where((at >= 0)[:, None], totals[at] - own[at], -open_sums[None, :])
            totals -= before
            first = (at < 0) & (not closed)
            yield from extended(table, totals, first, "row")
            closed = closed or bool(new.any())
            last, open_sums = table.slice(size - 1).combine_chunks(), totals[-1]
        if last is not None:
            if restart and last.column(restart)[0].as_py():
                closed, open_sums = True, np.zeros(len(sums), np.int64)
            yield from extended(last, open_sums[None, :], [False], "tail", closed)

    scanned = stored(ranged.mapInArrow(scan, schema), "running_scan")
    # One row per task from here to the join: the window over all tasks is that small, and so is
    # what is broadcast.
    tasks = Window.orderBy("_task")
    key = F.struct(*group)
    ends = (scanned.filter("_kind <> 'row'").groupBy("_task").agg(
        F.max(F.when(F.col("_kind") == "head", key)).alias("_from"),
        F.max(F.when(F.col("_kind") == "tail", key)).alias("_to"),
        F.max("_closed").alias("_closed"),
        *[F.max(F.when(F.col("_kind") == "tail", F.col(c))).alias(c) for c in sums]))
    goes_on = F.coalesce(F.lag("_to").over(tasks) == F.col("_from"), F.lit(False))
    ends = ends.select("_task", goes_on.alias("_goes_on"),
                       F.coalesce(F.lag("_closed").over(tasks), F.lit(True)).alias("_cut"),
                       *[F.coalesce(F.lag(_whole(v)).over(tasks), F.lit(0).cast(TOTAL))
                         .alias(f"_open_{v}") for v in values])
    # A chain of tasks through which one sum stays open.
    ends = ends.withColumn("_chain", F.sum(
        (~F.col("_goes_on") | F.col("_cut")).cast("int")).over(tasks))
    chain = Window.partitionBy("_chain").orderBy("_task").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carry = ends.select(F.col("_task").alias("_at"), *[
        F.sum(F.when(F.col("_goes_on"), F.col(f"_open_{v}")).otherwise(F.lit(0).cast(TOTAL)))
        .over(chain).cast(TOTAL).alias(f"_carry_{v}") for v in values])
    joined = scanned.filter("_kind = 'row'").join(
        F.broadcast(carry), F.col("_first") & (F.col("_task") == F.col("_at")), "left")
    return joined.select(*rows.columns, *[
        (_whole(v) + F.coalesce(f"_carry_{v}", F.lit(0).cast(TOTAL))).cast(TOTAL)
        .alias(f"sum_{v}") for v in values])


def line_item_effects(changes: DataFrame, key: Sequence[str], params: Q3Params = DEFAULT,
                      partitions: int | None = None) -> DataFrame:
    """Line-item changes (typed columns, ``op``, ``seq``) that take effect, with what they do:
    ``effect`` in units of 0.0001 and ``copies``.  An INSERT that passes the ship date adds its
    revenue; a DELETE takes away all its key had since the DELETE before it."""
    live = (F.col("op") == "INSERT") & shipped_after(params)
    rows = changes.withColumns({
        # Revenue has four places: a whole number of their unit (an error beyond 64 bits).
        "_value": F.when(live, (revenue() * 10000).cast("bigint")).otherwise(F.lit(0).cast("bigint")),
        "_copies": live.cast("bigint"), "_delete": F.col("op") == "DELETE"})
    rows = rows.withColumn("_copies", F.coalesce("_copies", F.lit(0).cast("bigint")))
    held = running_sums(rows, key, ["seq"], ["_value", "_copies"], restart="_delete",
                        partitions=partitions)
    effect = {v: F.when(F.col("_delete"), -F.col(f"sum_{v}")).otherwise(F.col(v)).cast("bigint")
              for v in ("_value", "_copies")}
    return held.select(*changes.columns, effect["_value"].alias("effect"),
                       effect["_copies"].alias("copies")).filter(F.col("copies") != 0)


def running_revenue(effects: DataFrame, group: Sequence[str], partitions: int | None = None,
                    ) -> DataFrame:
    """Every effect with the revenue and live rows of its group after it."""
    out = running_sums(effects, group, ["seq"], ["effect", "copies"], partitions=partitions)
    return out.withColumns({
        "revenue": (F.col("sum_effect") / F.lit(10000)).cast("decimal(18,4)"),
        "live": F.col("sum_copies").cast("bigint")}).drop("sum_effect", "sum_copies")
