"""Live audit (D10): counts per table, operation and status of each micro-batch, as it happens.

The counts are ``observe`` metrics on the lines on their way into the bronze table: no second pass
over them, and no read of the table afterwards.  When a batch's lines are written its counts are
kept as one small table per batch id and handed to ``notify``.  A retried batch replaces its own
counts, so it counts once; a restarted query goes on beside the batches already kept.

Counts have a fixed number of groups: tables of the layout or none of them (null), INSERT, DELETE
or another operation (``other``), and the verdicts of the parser.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import DRIVER, OPS, Layout
from ..sources import storage
from .normalise import BATCH_COL

# The parser's verdicts.
STATUSES = ("accepted", "blank", "too_few_parts", "unknown_table", "bad_arity", "unknown_op",
            "bad_value")
OTHER = "other"
SCHEMA = "tbl string, op string, status string, n bigint"

Counts = list[tuple[str | None, str, str, int]]


class LiveAudit:
    """Watches the batches of a changes query; pass ``watch`` as its ``on_batch``."""

    def __init__(self, spark: SparkSession, folder: str, layout: Layout = DRIVER,
                 notify: Callable[[int, Counts], None] | None = None) -> None:
        self.spark, self.folder, self.notify = spark, folder, notify
        self.groups = list(product((None, *layout.table_names), (OTHER, *OPS), STATUSES))
        self.tables = layout.table_names

    def watch(self, batch_id: int, parsed: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
        """The lines, observed, and what to call when they are written."""
        def place(column: Column, values: Sequence[str]) -> Column:
            """1, 2, ... for the values, 0 for any other."""
            return F.coalesce(F.array_position(F.array(*map(F.lit, values)), column), F.lit(0))

        group = ((place(F.col("tbl"), self.tables) * (len(OPS) + 1) + place(F.col("op"), OPS))
                 * len(STATUSES) + place(F.col("reason"), STATUSES[1:]))
        seen = Observation()
        # A bin for each group and as many again for parts yet to be joined: no two groups share one,
        # so the counts are exact.
        counts = F.histogram_numeric(group, F.lit(2 * len(self.groups))).alias("counts")

        def done() -> None:
            found = Counter()
            for x in seen.get["counts"] or ():
                found[int(x["x"])] += int(x["y"])
            rows = [(*g, found[i]) for i, g in enumerate(self.groups) if found[i]]
            (self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite")
             .parquet(f"{self.folder}/{BATCH_COL}={batch_id}"))
            if self.notify:
                self.notify(batch_id, rows)

        return parsed.observe(seen, counts), done

    def counts(self) -> DataFrame:
        """(tbl, op, status, n) over all batches so far."""
        storage.make_dirs(self.spark, self.folder)
        return (self.spark.read.schema(f"{SCHEMA}, {BATCH_COL} int").parquet(self.folder)
                .groupBy("tbl", "op", "status").agg(F.sum("n").alias("n")))
