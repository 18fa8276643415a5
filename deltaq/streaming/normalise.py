"""Turn one micro-batch of raw changes into signed net changes of the live table.

Raw INSERT/DELETE changes cannot be summed directly: a DELETE removes every live copy of its key
(or nothing), and a change may arrive in a later batch than a change with a larger ``seq``.  For
micro-batch ``N`` of one table:

    keys         =  delete keys of batch N
    after        =  live rows (replay rule) over changes b <= N, for those keys
    before       =  live rows over changes b <  N, for those keys
    signed       =  after (w=+1) minus before (w=-1), rows with w != 0

Both replays are fused: one aggregate gives each touched key its last DELETE seq over b <= N
and over b < N; one left join gives every INSERT row of those keys ``w = live now - live
before`` (in -1, 0, +1).  Repeated rows each carry their own weight; a late change re-applies the
rule to its key, so the sum of all signed batches always equals the batch replay.  Everything is
DataFrame work; no Python per key.

What a batch reads follows the batch, not the history.  The changes before the last compaction are
kept as live rows plus one marker per deleted key, in ``BUCKETS`` folders by a hash of the key, and
only the folders that the batch's keys fall into are read; the batches since then (at most
``COMPACT_EVERY``) are read as they are.  Earlier rows of the touched keys are written once per
batch (its own rows are read where they are); the last deletes are another small table, so the join
that gives the weights has a shuffle on both sides and AQE splits a hot key.  Where keys are many, a
bitmap of them keeps rows that cannot match out of the shuffles.

Batches that come ``in_order`` (every ``seq`` larger than all of earlier batches) need less: what came
earlier cannot touch a new row, and only keys that the batch deletes have earlier rows to take back.  So
only those keys are looked up, a batch without deletes looks at nothing but itself, and a compaction
joins only rows up to the last batch that deletes any.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bitmap import may_match
from ..operators.replay import bitmap_of, join_deletes, stored
from ..sources import storage

BATCH_COL = "b"
# Compact the change log after every this many batches (see ``compact``).
COMPACT_EVERY = 8
# Folders of the compacted log; a parameter of the log, fixed once it is written.
BUCKETS = 64


def last_compaction(batch_id: int, every: int) -> int:
    """Highest batch id already folded into a compaction when batch ``batch_id`` runs (-1: none).

    Batches every-1, 2*every-1, ... are the last of a compaction; the value depends only on the
    batch id, so a restarted query finds the same one without listing any folder."""
    return every * (batch_id // every) - 1


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def _step(df: DataFrame, log_path: str, name: str) -> DataFrame:
    """A table that lives for one batch: the next one's takes its place."""
    return stored(df, name, f"{log_path}/steps/{name}")


def compact(rows: DataFrame, key: Sequence[str], upto: int, log_path: str, seq: str = "seq",
            op: str = "op", in_order: bool = False) -> DataFrame:
    """Exact compaction: live INSERT rows, plus one DELETE marker per key with its last delete.

    An INSERT older than a DELETE of its key is dead for good (the last delete only grows), so
    dropping it changes no later answer; the marker keeps the last delete seq for late rows."""
    key = list(key)
    last_of = F.max(BATCH_COL if in_order else F.lit(None).cast("int")).alias("_b")
    dels = _step(rows.filter(F.col(op) == F.lit("DELETE")).groupBy(*key)
                 .agg(F.max(seq).alias("_d"), last_of), log_path, "compact_deletes")
    inserts, parts = rows.filter(F.col(op) == F.lit("INSERT")), []
    if in_order:
        # Of batches after the last one that deletes, every row is live.
        last = dels.agg(F.max("_b")).first()[0]
        last = -1 if last is None else last
        parts = [inserts.filter(F.col(BATCH_COL) > F.lit(last)).drop(BATCH_COL)]
        inserts = inserts.filter(F.col(BATCH_COL) <= F.lit(last))
    live = (join_deletes(inserts.drop(BATCH_COL), dels.drop("_b"), key,
                         f"{log_path}/steps/compact_bitmap")
            .filter(F.col("_d").isNull() | (F.col(seq) > F.col("_d"))).drop("_d"))
    markers = dels.select(*key, F.col("_d").alias(seq), F.lit("DELETE").alias(op))
    for part in parts:
        live = live.unionByName(part)
    out = live.unionByName(markers, allowMissingColumns=True)
    return out.withColumn(BATCH_COL, F.lit(upto).cast("int"))


def fold(spark: SparkSession, read: Callable[[list[int]], DataFrame], log_path: str, upto: int,
         key: Sequence[str], every: int, seq: str = "seq", op: str = "op",
         in_order: bool = False) -> None:
    """Write the compaction of batches 0..``upto``, which are done; what it replaces is removed one
    round later, so that a retried batch finds what it read."""
    since = last_compaction(upto, every)
    rows = read(list(range(since + 1, upto + 1)))
    if since >= 0:
        base = _compacted(spark, log_path, since, rows.schema).drop("kb")
        rows = base.unionByName(rows, allowMissingColumns=True)
    (compact(rows, key, upto, log_path, seq, op, in_order).withColumn("kb", bucket_of(key))
     .write.mode("overwrite").partitionBy("kb")
     .parquet(f"{log_path}/compact/upto={upto}", compression=storage.CODEC))
    for name in storage.children(spark, f"{log_path}/compact"):
        if name.startswith("upto=") and int(name[5:]) < since:
            storage.remove(spark, f"{log_path}/compact/{name}")


def _compacted(spark: SparkSession, log_path: str, upto: int, changes: T.StructType) -> DataFrame:
    """A compaction, with the columns of the changes and the bucket ``kb``; it may be empty."""
    schema = T.StructType([*changes.fields, T.StructField("kb", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{log_path}/compact/upto={upto}")


def normalise(spark: SparkSession, read: Callable[[list[int]], DataFrame], batch_id: int,
              log_path: str, key: Sequence[str], seq: str = "seq", op: str = "op",
              every: int = COMPACT_EVERY, ahead: bool = True, in_order: bool = False) -> DataFrame:
    """Signed net change caused by batch ``batch_id``.

    ``read`` gives the typed changes of the batches asked for, with their batch id in column ``b``
    (in the streaming job: the bronze table, routed).  ``log_path`` keeps this table's
    compactions; one is written ``ahead`` by the last batch it holds, or by the first that reads
    it, so that none is written in vain.  ``in_order`` promises that a batch's ``seq`` are larger than
    all of the batches before it."""
    key = list(key)
    since = last_compaction(batch_id, every)
    if ahead and (batch_id + 1) % every == 0:
        # fold this batch too; the next batch reads the result instead of the raw history
        fold(spark, read, log_path, batch_id, key, every, seq, op, in_order)
    elif not ahead and 0 <= since == batch_id - 1:
        fold(spark, read, log_path, since, key, every, seq, op, in_order)
    recent = read(list(range(since + 1, batch_id + 1)))
    # All rows of the batch are of touched keys; only what came earlier is looked through for them.
    current = recent.filter(F.col(BATCH_COL) == F.lit(batch_id))
    asking = current.filter(F.col(op) == F.lit("DELETE")) if in_order else current
    keys = _step(asking.select(*[F.col(k).alias(f"_k_{k}") for k in key]).distinct(), log_path,
                 "touched_keys")
    if in_order and keys.isEmpty():
        return (current.filter(F.col(op) == F.lit("INSERT")).drop(op, BATCH_COL)
                .withColumn("w", F.lit(1)))
    parts = []
    if batch_id > since + 1:
        parts.append(recent.filter(F.col(BATCH_COL) < F.lit(batch_id)))
    if since >= 0:
        # At most BUCKETS numbers: the folders that hold a touched key.
        asked = keys.select(bucket_of([f"_k_{k}" for k in key]).alias("kb")).distinct()
        wanted = sorted(r.kb for r in asked.collect())
        base = _compacted(spark, log_path, since, recent.schema)
        parts.append(base.filter(F.col("kb").isin(wanted)).drop("kb"))
    touched = current
    if parts:
        match = None
        for k in key:
            cond = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            match = cond if match is None else match & cond
        bitmap = bitmap_of(keys, [f"_k_{k}" for k in key], f"{log_path}/steps/touched_bitmap")
        if bitmap:
            parts = [may_match(p, key, *bitmap) for p in parts]
        before = parts[0]
        for p in parts[1:]:
            before = before.unionByName(p, allowMissingColumns=True)
        # The keys are distinct, so this is a semi join; as one, Spark would move it below the bitmap,
        # and all earlier rows would be shuffled.
        before = _step(before.join(keys, match).select(*before.columns), log_path, "touched_rows")
        touched = current.unionByName(before, allowMissingColumns=True)
    # Last delete per touched key, with and without this batch: one partial/final aggregate.
    earlier = F.col(BATCH_COL) < F.lit(batch_id)
    dels = _step(touched.filter(F.col(op) == F.lit("DELETE")).groupBy(*key)
                 .agg(F.max(seq).alias("_d_now"),
                      F.max(F.when(earlier, F.col(seq))).alias("_d_before")),
                 log_path, "touched_deletes")
    ins = touched.filter(F.col(op) == F.lit("INSERT"))
    # NULL keys never match a delete, as in SQL
    rows = join_deletes(ins, dels, key, f"{log_path}/steps/deletes_bitmap")
    live_now = F.col("_d_now").isNull() | (F.col(seq) > F.col("_d_now"))
    live_before = earlier & (F.col("_d_before").isNull() | (F.col(seq) > F.col("_d_before")))
    w = live_now.cast("int") - live_before.cast("int")
    cols = [c for c in ins.columns if c not in (op, BATCH_COL)]
    return rows.select(*cols, w.alias("w")).filter(F.col("w") != F.lit(0))
