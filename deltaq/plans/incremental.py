"""Queries over the incremental path: streaming runs over the rounds changelog, and the same
weight algebra evaluated in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import ordered_before, revenue, segment_is, shipped_after, to_revenue
from ..operators import parse as P
from ..params import DEFAULT, Q3Params
from ..schemas import DRIVER
from ..session import work_dir
from ..operators.synth import ROUND_OPS, ROUND_RULES, round_changes
from ..sources import storage
from ..sources.changelog import ARRIVAL, write_changelog
from ..sources.tables import load_tables
from ..streaming import incremental as I
from ..streaming import keyed as K
from ..streaming.live_audit import LiveAudit
from ..streaming.normalise import normalise
from . import changes as C

# Compact every second batch in the registered runs, so the compaction is always exercised.
COMPACT_EVERY = 2
ROUNDS = len(ROUND_OPS)


# Rows of the tables from which the writer of a round tells where its parts begin.
SAMPLED = 0.01


def changes_run(spark: SparkSession, sf_dir: str, each=None,
                changes: Callable[[int, float | None], DataFrame] | None = None,
                rounds: int = ROUNDS, on_batch=None) -> I.Paths:
    """Feed the rounds changelog to the streaming changes query, one round after another: each
    round arrives as one micro-batch, whatever the session's settings, and the query resumes from
    its checkpoint for the next.  ``changes`` gives the changes of a round, or those of a share of
    the tables' rows; ``each`` runs after every round (the queries downstream)."""
    paths = I.Paths(work_dir(spark, "stream"))
    text = paths.of("text")
    changes = changes or (lambda r, share: C.rounds(spark, sf_dir, only=r, share=share))
    for r in range(rounds):
        write_changelog(changes(r, None), text, mode="append", sample=changes(r, SAMPLED))
        I.run_changes(spark, text, paths, DRIVER, files_per_trigger=None,
                      compact_every=COMPACT_EVERY, order=ARRIVAL, on_batch=on_batch)
        if each is not None:
            each(paths)
    return paths


def q3_run(spark: SparkSession, sf_dir: str, each=None) -> I.Paths:
    """The changes query and the join query, the join draining every round before the next; the
    delta log is folded once on the way."""
    done = []

    def join(paths: I.Paths) -> None:
        I.drained(I.start_join(spark, paths))
        if each is not None:
            each(paths)
        done.append(len(done))
        if len(done) == ROUNDS // 2:
            I.fold_delta(spark, paths.delta, done[-1])
    return changes_run(spark, sf_dir, join)


def stream_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.snapshot(spark, q3_run(spark, sf_dir).delta)


def stream_normalized(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Sum of all signed batches of one table: the live rows with their multiplicity."""
    paths = changes_run(spark, sf_dir)
    cols = DRIVER[table].names
    signed = spark.read.parquet(paths.of("signed", table))
    return (signed.groupBy(*cols).agg(F.sum("w").alias("w")).filter(F.col("w") != 0))


def stream_join_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1/J2 alone: customer sums (segment) x order changes (date), netted per order row."""
    def join(paths: I.Paths) -> None:
        df = I.salted_orders_join(spark, paths).select(
            "o_orderkey", "o_custkey", "o_orderdate", (F.col("cw") * F.col("ow")).alias("w"))
        I.drained(I.start_sink(df, paths.of("delta_co"), paths.of("checkpoints", "join_co")))

    paths = changes_run(spark, sf_dir, join)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate date, w bigint"
    return (spark.read.schema(schema).parquet(paths.of("delta_co"))
            .groupBy("o_orderkey", "o_custkey", "o_orderdate")
            .agg(F.sum("w").alias("w")).filter(F.col("w") != 0))


def stream_keyed_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J4 on Spark's keyed state: both joins drain every round; the snapshot of their changes."""
    paths = changes_run(spark, sf_dir, lambda paths: K.drain(spark, paths))
    return K.keyed_snapshot(spark, paths)


# A round after the others that inserts some customers once more, so that many are
# live twice.
REPEATED = {"customer": "c_custkey % 3 = 0", "orders": "FALSE", "lineitem": "FALSE"}


def stream_semi_join_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 in the stream: orders (before the date) that have a live customer in the segment, each as
    often as it is live itself, however often its customer is."""
    rules = {t: (*rules, REPEATED[t]) for t, rules in ROUND_RULES.items()}

    def changes(r: int, share: float | None) -> DataFrame:
        return round_changes(load_tables(spark, sf_dir, share), DRIVER, rules,
                             (*ROUND_OPS, "INSERT"), r)

    def gate(paths: I.Paths) -> None:
        I.drained(K.start_keyed(K.gated_orders(spark, I.prepare(spark, paths)), paths.of("gated"),
                                paths.of("checkpoints", "gated")))

    paths = changes_run(spark, sf_dir, gate, changes, ROUNDS + 1)
    return (spark.read.schema(K.JOINED_ORDERS).parquet(paths.of("gated"))
            .groupBy("o_orderkey", "o_custkey", "o_orderdate").agg(F.sum("w").alias("w"))
            .filter(F.col("w") != 0))


RUNNING = (f"{', '.join(c + ' ' + t for c, t in zip(I.GROUP, ('bigint', 'date', 'int')))}, "
           "revenue decimal(18,4), live bigint, version int")


def running_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update-mode output of the running aggregate: for every round, each group that the
    round changed, with its revenue and live rows as of that round."""
    def running(paths: I.Paths) -> None:
        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(paths.of("running", f"b={batch_id}"))
        I.drained(I.running_revenue(spark, paths.delta).writeStream.outputMode("update")
                  .foreachBatch(keep)
                  .option("checkpointLocation", paths.of("checkpoints", "running"))
                  .trigger(availableNow=True).start())

    paths = q3_run(spark, sf_dir, running)
    storage.make_dirs(spark, paths.of("running"))
    return spark.read.schema(RUNNING).parquet(paths.of("running")).select(
        *I.GROUP, "revenue", "live", "version")


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 + D7: latest running total per group (max_by version), groups with live rows only."""
    upd = running_updates(spark, sf_dir)
    last = upd.groupBy(*I.GROUP).agg(
        F.max_by(F.struct("revenue", "live"), "version").alias("_last"))
    return (last.filter(F.col("_last.live") > 0)
            .select(*I.GROUP, F.col("_last.revenue").alias("revenue")))


# --- the same algebra in batch ------------------------------------------------------------------

ROUND_BITS = 40


def batch_signed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Normalise the rounds changelog round by round (each round one batch), all tables."""
    paths = I.Paths(work_dir(spark, "batch_signed"))
    staged = C.staged(spark, C.parsed_lines(C.rounds(spark, sf_dir)), "batch_bronze")
    for spec in DRIVER.tables:
        changes = P.route(staged, spec.name, DRIVER).withColumn(
            "b", F.shiftright("seq", ROUND_BITS).cast("int"))

        def read(batches: list[int], changes=changes) -> DataFrame:
            return changes.filter(F.col("b").isin(batches))
        for r in range(ROUNDS):
            signed = normalise(spark, read, r, paths.of("log", spec.name), spec.key,
                               every=COMPACT_EVERY, ahead=False, in_order=True)
            signed.write.mode("overwrite").parquet(paths.of("signed", spec.name, f"b={r}"),
                                                   compression=storage.CODEC)
    return {t: spark.read.parquet(paths.of("signed", t)) for t in DRIVER.table_names}


def q3_from_signed(signed: dict[str, DataFrame], params: Q3Params = DEFAULT) -> DataFrame:
    """D3 in batch: per group SUM(cw*ow*lw*rev) as ``_rev`` and SUM(cw*ow*lw) as ``_n`` over
    signed rows (column ``w``) of the three tables.  Customers and items are summed per join key
    first (the join is linear in each side), so each join is many-to-one on those sides."""
    cust = signed["customer"].filter(segment_is(params)).groupBy("c_custkey") \
        .agg(F.sum("w").alias("cw"))
    o = signed["orders"]
    prio = F.col("o_shippriority") if "o_shippriority" in o.columns else F.lit(0).cast("int")
    orders = o.filter(ordered_before(params)).select(
        "o_orderkey", "o_custkey", "o_orderdate", prio.alias("o_shippriority"),
        F.col("w").alias("ow"))
    items = signed["lineitem"].filter(shipped_after(params)).groupBy("l_orderkey").agg(
        F.sum(revenue() * F.col("w")).alias("lrev"), F.sum("w").alias("lw"))
    j = items.join(orders.join(cust, F.col("o_custkey") == F.col("c_custkey")),
                   F.col("l_orderkey") == F.col("o_orderkey"))
    return (j.groupBy("l_orderkey", "o_orderdate", "o_shippriority")
            .agg(F.sum(F.col("lrev") * F.col("ow") * F.col("cw")).alias("_rev"),
                 F.sum(F.col("lw") * F.col("ow") * F.col("cw")).alias("_n")))


def live_groups(groups: DataFrame) -> DataFrame:
    """D7 + D8: groups with live rows, revenue rounded to 4 decimals."""
    return groups.filter(F.col("_n") > 0).select(*I.GROUP,
                                                 to_revenue(F.col("_rev")).alias("revenue"))


def weighted_groups(spark: SparkSession, sf_dir: str, params: Q3Params = DEFAULT) -> DataFrame:
    return q3_from_signed(batch_signed(spark, sf_dir), params)


def incremental_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_groups(weighted_groups(spark, sf_dir))


def drop_dead_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that had rows at some point but none are live now (dropped at output)."""
    g = weighted_groups(spark, sf_dir)
    return g.filter(F.col("_n") == 0).select(*I.GROUP)


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 over the streaming run: every line the changes query saw, by table, op and status."""
    return I.audit(spark, changes_run(spark, sf_dir), DRIVER)


def stream_live_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 as it happens: the counts that each micro-batch gave while its lines were written."""
    live = LiveAudit(spark, work_dir(spark, "live_audit"), DRIVER)
    changes_run(spark, sf_dir, on_batch=live.watch)
    return live.counts()
