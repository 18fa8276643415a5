"""Incremental flagship query with Structured Streaming and signed row weights.

Two streaming queries and one batch read, all under one work folder in the shared checkpoint
location:

    changes   text dir --readStream.text--> foreachBatch:
                stamp seq, parse, bronze/b=N (typed; bad lines kept with a reason; the bronze
                table is also the change log), normalise each table (signed net change),
                signed/<table>/b=N, per-key sums for the join published as q3in/<table>/b=N
    join      q3in customer  sums per key, segment filter   --+
              q3in orders    per order, date filter        --+-- stream-stream inner joins
              q3in lineitem  sums per order, date filter   --+   (customer side salted),
                w = cw * ow * lw, wrev = lrev * cw * ow,       append mode
                version = the latest batch that a pair comes from
                --> delta log (parquet file sink by version, exactly once via its commit log)
    snapshot  batch: folded delta log + versions since -> GROUP BY keys: SUM(w * rev), SUM(w);
              keep SUM(w) > 0

A join is linear in each input, so summing weighted pairs over any arrival order gives the join
of the net tables.  Join state is kept by Spark's state store (RocksDB when configured), one
entry per input row (per key and batch for items and customers); like the reference, nothing is
ever evicted (no watermark).

A batch's join input appears in one step: it is written beside its place and renamed, and a batch
whose input is in place is never written again.  So a retried batch cannot be read twice, whenever
the join runs and whatever markers the writer leaves.  The watched folders are made before either
query starts, so the two can start in any order.

``running`` (D4) is a third streaming query over the delta log, aggregated in update mode: one
row per changed group per micro-batch, with the version that changed it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.expressions import ordered_before, revenue, segment_is, shipped_after, to_revenue
from ..operators import parse as P
from ..params import DEFAULT, Q3Params
from ..schemas import DRIVER, Layout
from ..sources import storage
from ..sources.bronze import read_bronze, write_bronze
from ..sources.changelog import (
    ARRIVAL, NAME, WIDTHS, OrderError, batch_order, read_changelog_stream, source_columns)
from .normalise import BATCH_COL, COMPACT_EVERY, normalise

#: (batch id, parsed lines) -> the lines to write, and what to call when they are written.
OnBatch = Callable[[int, DataFrame], tuple[DataFrame, Callable[[], None]]]

GROUP = ["l_orderkey", "o_orderdate", "o_shippriority"]
WREV = T.DecimalType(38, 4)


@dataclass(frozen=True)
class Paths:
    work: str

    def of(self, *parts: str) -> str:
        return "/".join([self.work.rstrip("/"), *parts])

    @property
    def delta(self) -> str:
        return self.of("delta")


def q3_input(table: str, signed: DataFrame, params: Q3Params = DEFAULT) -> DataFrame:
    """Filtered signed changes of one batch and table, summed per join key (pre-aggregated
    before the join's shuffle).  A hot order or customer becomes one row per batch, so the join
    state and its partitions stay small whatever the key distribution.  Linear, so exact."""
    if table == "customer":
        return (signed.filter(segment_is(params)).groupBy("c_custkey")
                .agg(F.sum("w").alias("cw")).filter(F.col("cw") != 0))
    if table == "orders":
        prio = (F.col("o_shippriority") if "o_shippriority" in signed.columns
                else F.lit(0).cast("int"))
        return (signed.filter(ordered_before(params))
                .groupBy("o_orderkey", "o_custkey", "o_orderdate", prio.alias("o_shippriority"))
                .agg(F.sum("w").alias("ow")).filter(F.col("ow") != 0))
    return (signed.filter(shipped_after(params)).groupBy("l_orderkey")
            .agg(F.sum(revenue() * F.col("w")).cast(WREV).alias("lrev"),
                 F.sum("w").alias("lw"))
            .filter((F.col("lw") != 0) | (F.col("lrev") != 0)))


TABLES = ("customer", "orders", "lineitem")


def prepare(spark: SparkSession, paths: Paths) -> Paths:
    """Make the folders that streaming queries watch."""
    for folder in [paths.delta, *[paths.of("q3in", t) for t in TABLES]]:
        storage.make_dirs(spark, folder)
    return paths


def check_places(spark: SparkSession, paths: Paths, batch_id: int, places: dict[str, int]) -> None:
    """Keep the files of a micro-batch (one row each) and fail where one takes the place of a file
    of an earlier batch."""
    folder = paths.of("files")
    (spark.createDataFrame(list(places.items()), "file string, place bigint").coalesce(1)
     .write.mode("overwrite").parquet(f"{folder}/{BATCH_COL}={batch_id}"))
    tie = (spark.read.schema(f"file string, place bigint, {BATCH_COL} int").parquet(folder)
           .groupBy("place").agg(F.min("file").alias("a"), F.max("file").alias("b"))
           .filter("a <> b").first())
    if tie:
        raise OrderError(f"nothing in their names orders {tie.a} and {tie.b}")


def process_changes(spark: SparkSession, paths: Paths, layout: Layout = DRIVER,
                    params: Q3Params = DEFAULT, compact_every: int = COMPACT_EVERY,
                    order: str = NAME, root: str = "", widths: Sequence[int] = WIDTHS,
                    on_batch: OnBatch | None = None):
    """The foreachBatch body of the changes query.  ``root`` is the folder of the changelog;
    ``on_batch`` may watch the parsed lines of each batch (see ``live_audit``)."""
    root = storage.qualified(spark, root) if root else ""

    def run(batch: DataFrame, batch_id: int) -> None:
        lines, places = batch_order(batch, root, batch_id, order, widths)
        if order == NAME:
            check_places(spark, paths, batch_id, places)
        part = f"{BATCH_COL}={batch_id}"
        parsed = P.parse(lines, layout)
        parsed, written = on_batch(batch_id, parsed) if on_batch else (parsed, None)
        write_bronze(parsed, paths.of("bronze", part), layout)
        if written:
            written()

        def one(spec) -> None:
            # The bronze table is the change log: of it, only the batches asked for are read.
            def read(batches: list[int]) -> DataFrame:
                return P.route(read_bronze(spark, paths.of("bronze"), layout, batches=batches),
                               spec.name, layout, passthrough=("seq", BATCH_COL))

            signed = normalise(spark, read, batch_id, paths.of("log", spec.name), spec.key,
                               every=compact_every, ahead=False, in_order=order == ARRIVAL)
            out = paths.of("signed", spec.name, part)
            (signed.withColumn("w", F.col("w").cast("bigint")).write.mode("overwrite")
             .parquet(out, compression=storage.CODEC))
            storage.publish(q3_input(spec.name, spark.read.parquet(out), params),
                            paths.of("q3in_staging", spec.name, part),
                            paths.of("q3in", spec.name, part))
        # The tables are independent: submit their jobs side by side.
        with ThreadPoolExecutor(max_workers=len(layout.tables)) as pool:
            for f in [pool.submit(one, spec) for spec in layout.tables]:
                f.result()
    return run


def start_changes(spark: SparkSession, changelog_dir: str, paths: Paths,
                  layout: Layout = DRIVER, files_per_trigger: int | None = 1,
                  available_now: bool = True, processing_time: str | None = None,
                  params: Q3Params = DEFAULT, wrap=None,
                  compact_every: int = COMPACT_EVERY, order: str = NAME,
                  bytes_per_trigger: str | None = None, widths: Sequence[int] = WIDTHS,
                  on_batch: OnBatch | None = None,
                  ) -> StreamingQuery:
    """Start the changes query; ``wrap`` may decorate the batch function (tests use it)."""
    src = source_columns(
        read_changelog_stream(spark, changelog_dir, files_per_trigger, bytes_per_trigger))
    fn = process_changes(spark, prepare(spark, paths), layout, params, compact_every, order,
                         changelog_dir, widths, on_batch)
    w = (src.writeStream.foreachBatch(wrap(fn) if wrap else fn)
         .option("checkpointLocation", paths.of("checkpoints", "changes")))
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


Q3IN_SCHEMA = {
    "customer": T.StructType([T.StructField("c_custkey", T.LongType()),
                              T.StructField("cw", T.LongType())]),
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderdate", T.DateType()),
                            T.StructField("o_shippriority", T.IntegerType()),
                            T.StructField("ow", T.LongType())]),
    "lineitem": T.StructType([T.StructField("l_orderkey", T.LongType()),
                              T.StructField("lrev", T.DecimalType(38, 4)),
                              T.StructField("lw", T.LongType())]),
}


def q3_stream(spark: SparkSession, paths: Paths, table: str) -> DataFrame:
    schema = T.StructType(Q3IN_SCHEMA[table].fields + [T.StructField(BATCH_COL, T.IntegerType())])
    return spark.readStream.schema(schema).parquet(paths.of("q3in", table)).withColumnRenamed(
        BATCH_COL, f"_b_{table}")


# Salts of the customer join: a customer's orders are spread over this many join partitions.  A
# parameter of the join query, kept with its checkpoint: state written with one number cannot be
# read with another.
CUSTOMER_SALTS = 16


def join_salts(spark: SparkSession, paths: Paths, salts: int | None = None) -> int:
    """The number of salts this join runs with: the stored one, or ``salts`` on its first start."""
    place = paths.of("checkpoints", "join_salts")
    if storage.exists(spark, place):
        stored_salts = int(spark.read.text(place).first()["value"])
        if salts is not None and salts != stored_salts:
            raise ValueError(f"the join was started with {stored_salts} salts, not {salts}")
        return stored_salts
    salts = salts or CUSTOMER_SALTS
    spark.createDataFrame([(str(salts),)], "value string").coalesce(1).write.text(place)
    return salts


def salted_orders_join(spark: SparkSession, paths: Paths, salts: int = CUSTOMER_SALTS
                       ) -> DataFrame:
    """Order changes x customer sums on (custkey, salt); see ``joined_items``."""
    cust = q3_stream(spark, paths, "customer").withColumn(
        "c_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    orders = q3_stream(spark, paths, "orders").withColumn(
        "o_salt", F.pmod(F.xxhash64("o_orderkey"), F.lit(salts)).cast("int"))
    return orders.join(cust, (F.col("o_custkey") == F.col("c_custkey"))
                       & (F.col("o_salt") == F.col("c_salt")), "inner")


def joined_items(spark: SparkSession, paths: Paths, salts: int = CUSTOMER_SALTS) -> DataFrame:
    """Per-batch item sums x orders x customer sums, stream-stream inner joins.

    Weight of a pair = cw * ow * lw, weighted revenue = lrev * cw * ow.  Inputs are already
    filtered by the query parameters (in the changes query).  Item and customer inputs are one
    row per key and batch; orders cannot be summed away, so the customer join is salted: every
    customer row is copied to ``salts`` salts and every order goes to the salt given by a hash
    of its order key.  Each order meets each copy of its customer exactly once, so the weights
    stay exact while a customer holding a third of all orders spreads over ``salts`` partitions.
    """
    co = salted_orders_join(spark, paths, salts)
    items = q3_stream(spark, paths, "lineitem")
    j = items.join(co, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    cw_ow = F.col("cw") * F.col("ow")
    return j.select("l_orderkey", "o_orderdate", "o_shippriority",
                    (F.col("lw") * cw_ow).alias("w"), (F.col("lrev") * cw_ow).alias("wrev"),
                    F.greatest(*[f"_b_{t}" for t in TABLES]).alias("version"))


def start_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
               processing_time: str | None = None, by: str | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.partitionBy(by) if by else w
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "10 seconds")
    return w.start(path)


def start_join(spark: SparkSession, paths: Paths, salts: int | None = None, **trigger,
               ) -> StreamingQuery:
    prepare(spark, paths)
    return start_sink(joined_items(spark, paths, join_salts(spark, paths, salts)), paths.delta,
                      paths.of("checkpoints", "join"), by="version", **trigger)


DELTA_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_shippriority", T.IntegerType()), T.StructField("w", T.LongType()),
    T.StructField("wrev", T.DecimalType(38, 4)), T.StructField("version", T.IntegerType())])


def _sums(delta: DataFrame) -> DataFrame:
    return delta.groupBy(*GROUP).agg(F.sum("wrev").cast(WREV).alias("wrev"), F.sum("w").alias("w"))


def last_fold(spark: SparkSession, delta_path: str) -> int:
    done = [int(n[5:]) for n in storage.children(spark, f"{delta_path}_folds")
            if n.startswith("upto=")]
    return max(done, default=-1)


def delta_rows(spark: SparkSession, delta_path: str) -> DataFrame:
    """Weighted pairs per group: the last fold plus the versions after it."""
    upto = last_fold(spark, delta_path)
    log = spark.read.schema(DELTA_SCHEMA).parquet(delta_path).filter(F.col("version") > upto)
    log = log.select(*GROUP, "w", "wrev")
    if upto < 0:
        return log
    return spark.read.parquet(f"{delta_path}_folds/upto={upto}").select(
        *GROUP, "w", "wrev").unionByName(log)


def fold_delta(spark: SparkSession, delta_path: str, upto: int) -> None:
    """Fold the versions up to ``upto``, which the join must have drained, into one row per group,
    so that a snapshot reads the live groups and the versions since, not the whole history.  A
    version only ever gets rows from its own batch on, so the fold stays right."""
    if upto <= last_fold(spark, delta_path):
        return
    since = last_fold(spark, delta_path)
    rows = spark.read.schema(DELTA_SCHEMA).parquet(delta_path).filter(
        (F.col("version") > since) & (F.col("version") <= upto)).select(*GROUP, "w", "wrev")
    if since >= 0:
        rows = rows.unionByName(spark.read.parquet(f"{delta_path}_folds/upto={since}"))
    sums = _sums(rows).filter((F.col("w") != 0) | (F.col("wrev") != 0))
    storage.publish(sums, f"{delta_path}_folding/upto={upto}", f"{delta_path}_folds/upto={upto}")


def snapshot(spark: SparkSession, delta_path: str) -> DataFrame:
    """C8 + D3 + D5 + D7 + D8: current result from the delta log."""
    return _sums(delta_rows(spark, delta_path)).filter(F.col("w") > 0).select(
        *GROUP, to_revenue(F.col("wrev")).alias("revenue"))


def running_revenue(spark: SparkSession, delta_path: str) -> DataFrame:
    """D4 (streaming): running total, live count and latest version per group, for update mode."""
    return (spark.readStream.schema(DELTA_SCHEMA).parquet(delta_path).groupBy(*GROUP)
            .agg(to_revenue(F.sum("wrev")).alias("revenue"), F.sum("w").alias("live"),
                 F.max("version").alias("version")))


def drained(query: StreamingQuery) -> None:
    """Wait for an available-now query; raise what stopped it."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def run_changes(spark: SparkSession, changelog_dir: str, paths: Paths, layout: Layout = DRIVER,
                files_per_trigger: int | None = 1, params: Q3Params = DEFAULT,
                compact_every: int = COMPACT_EVERY, order: str = NAME,
                widths: Sequence[int] = WIDTHS,
                on_batch: OnBatch | None = None) -> None:
    drained(start_changes(spark, changelog_dir, paths, layout, files_per_trigger, params=params,
                          compact_every=compact_every, order=order, widths=widths,
                          on_batch=on_batch))


def run_q3(spark: SparkSession, changelog_dir: str, paths: Paths, params: Q3Params = DEFAULT,
           layout: Layout = DRIVER, files_per_trigger: int | None = 1, order: str = NAME,
           widths: Sequence[int] = WIDTHS) -> DataFrame:
    """Drain the changelog through both streaming queries, then return the snapshot."""
    run_changes(spark, changelog_dir, paths, layout, files_per_trigger, params, order=order,
                widths=widths)
    drained(start_join(spark, paths))
    return snapshot(spark, paths.delta)


def audit(spark: SparkSession, paths: Paths, layout: Layout = DRIVER) -> DataFrame:
    """D10 for the stream: lines per (table, operation, status) over every processed batch.

    The bronze table keeps every line with its verdict, so the audit is one aggregate over it."""
    lines = read_bronze(spark, paths.of("bronze"), layout)
    return (lines.groupBy("tbl", "op", F.coalesce("reason", F.lit("accepted")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))
