"""Replay a changelog into live tables (C1-C3), check deletes (C6) and count live rows.

Rule (the reference's SQL replay): an INSERTed row is live iff no DELETE for its key has a larger
``seq``.  Rows are a bag: repeated INSERTs stay repeated, and a DELETE removes every copy.

The plan avoids per-key windows, which would put all rows of a hot key into one task:

    deletes --partial/final max(seq) per key--> table --+
    inserts ----------------------------------- left join on key --> keep seq > max delete seq

The last deletes (one row per key after a map-side partial aggregate) are written to the shared
folder and joined from their scan, so both join sides come straight from a shuffle and AQE can split
a hot insert key over many tasks; where the deletes are measured small, AQE broadcasts them.  Where
they are many, a bitmap of their keys is broadcast instead (``join_deletes``): rows of keys that were
never deleted are neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import work_dir
from ..sources.storage import CODEC
from .bitmap import FILTER_BITS, FILTER_KEYS, cannot_match, key_bitmap, may_match

#: Keys from which a bitmap of them is made; fewer (some 1 MB) cost less than the bitmap's own jobs.
FILTER_FROM = 100_000


def last_delete(changes: DataFrame, key: Sequence[str], seq: str = "seq",
                op: str = "op") -> DataFrame:
    return (changes.filter(F.col(op) == F.lit("DELETE")).groupBy(*key)
            .agg(F.max(seq).alias("_del_seq")))


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder (or to ``path``) and read back."""
    path = path or work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap_of(keys: DataFrame, key: Sequence[str], path: str | None = None,
              ) -> tuple[DataFrame, int] | None:
    """The bitmap of a written table of distinct keys and its size in bits; none where the keys are
    few (``FILTER_FROM``) or more than a bitmap is made for."""
    n = keys.count()
    if not FILTER_FROM <= n <= FILTER_KEYS:
        return None
    bits = n * FILTER_BITS
    return stored(key_bitmap(keys, key, bits), "key_bitmap", path), bits


def join_deletes(rows: DataFrame, dels: DataFrame, key: Sequence[str], path: str | None = None,
                 ) -> DataFrame:
    """``rows`` left-joined to the written last deletes (one row per key).  Rows that no delete can
    match, by a bitmap of the deleted keys, stay where they are."""
    key = list(key)
    bitmap = bitmap_of(dels, key, path)
    if bitmap is None:
        return rows.join(dels, on=key, how="left")
    found = may_match(rows, key, *bitmap).join(dels, on=key, how="left")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in dels.dtypes if c not in key]
    return found.unionByName(cannot_match(rows, key, *bitmap).select("*", *nothing))


def live(changes: DataFrame, key: Sequence[str], seq: str = "seq", op: str = "op") -> DataFrame:
    """Live rows (all columns but ``op``) after applying the changes in ``seq`` order."""
    dels = stored(last_delete(changes, key, seq, op), "last_deletes")
    joined = join_deletes(changes.filter(F.col(op) == F.lit("INSERT")).drop(op), dels, key)
    return (joined.filter(F.col("_del_seq").isNull() | (F.col(seq) > F.col("_del_seq")))
            .drop("_del_seq"))


def live_counts(live_rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of live copies per key (partial aggregation first, so hot keys are cheap)."""
    return live_rows.groupBy(*key).agg(F.count(F.lit(1)).alias("live"))


_EFFECT_FIELDS = [T.StructField("_pid", T.IntegerType()), T.StructField("_kind", T.StringType()),
                  T.StructField("_ins", T.BooleanType()), T.StructField("_eff", T.BooleanType())]


def delete_effects(changes: DataFrame, key: Sequence[str], seq: str = "seq", op: str = "op",
                   partitions: int | None = None) -> DataFrame:
    """Every DELETE with ``effective`` = it removes at least one live row.

    A DELETE removes something iff the change just before it for the same key (in ``seq``
    order) is an INSERT.  Instead of a window per key (one task per key), the changes are
    range-partitioned on ``(key, seq)``, which splits a hot key over many tasks; each task scans
    its sorted rows once, vectorised per Arrow batch.  Only the first row of a task can have its predecessor in another
    task: those few rows (at most one per task) are resolved against the last row of the
    preceding non-empty task, a table with one row per task.
    """
    spark = changes.sparkSession
    n = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    key = list(key)
    ev = changes.select(*key, F.col(seq).alias("_seq"),
                        (F.col(op) == F.lit("INSERT")).alias("_is_ins"))
    ev = ev.repartitionByRange(n, *[F.col(k) for k in key], F.col("_seq")) \
        .sortWithinPartitions(*key, "_seq")
    in_fields = [f for f in ev.schema.fields]
    out_schema = T.StructType(in_fields + _EFFECT_FIELDS)

    def scan(batches):
        """Compare each row with the row before it, exactly (no conversion of the keys); the last
        row of a batch is put before the next one."""
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        columns = [f.name for f in in_fields]
        before = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            both = rows if before is None else pa.concat_tables([before, rows])
            n, skip = both.num_rows, 0 if before is None else 1
            same = pa.chunked_array([pa.array([True] * (n - 1), pa.bool_())])
            for k in key:                              # NULL keys never compare equal
                column = both.column(k)
                equal = pc.equal(column.slice(1), column.slice(0, n - 1))
                same = pc.and_(same, pc.fill_null(equal, False))
            effective = pc.and_(same, both.column("_is_ins").slice(0, n - 1)).combine_chunks()
            is_ins = rows.column("_is_ins").combine_chunks()
            kinds = ["row"] * rows.num_rows
            if not skip:                               # first row of the task: resolved later
                effective = pa.concat_arrays([pa.array([None], pa.bool_()), effective])
                kinds[0] = "row" if is_ins[0].as_py() else "head"
            out = rows.append_column("_pid", pa.array([pid] * rows.num_rows, pa.int32()))
            out = out.append_column("_kind", pa.array(kinds)).append_column("_ins", is_ins)
            out = out.append_column("_eff", effective)
            yield from out.filter(pc.invert(is_ins)).to_batches()
            before = rows.slice(rows.num_rows - 1).combine_chunks()
        if before is not None:
            tail = before.append_column("_pid", pa.array([pid], pa.int32()))
            tail = tail.append_column("_kind", pa.array(["tail"]))
            tail = tail.append_column("_ins", before.column("_is_ins"))
            yield from tail.append_column("_eff", pa.array([None], pa.bool_())).to_batches()

    scanned = ev.mapInArrow(scan, out_schema)
    deletes = scanned.filter(F.col("_kind").isin("row", "head"))
    tails = scanned.filter(F.col("_kind") == "tail").select(
        F.col("_pid").alias("_t_pid"), *[F.col(k).alias(f"_t_{k}") for k in key],
        F.col("_ins").alias("_t_ins"))
    # For each task with rows, the tail of the closest earlier task with rows.  One row per task,
    # so both the window and the broadcast are bounded by the partition count.
    prev = tails.withColumn("_next_pid", F.lead("_t_pid").over(Window.orderBy("_t_pid")))
    joined = deletes.join(F.broadcast(prev), (F.col("_pid") == F.col("_next_pid"))
                          & (F.col("_kind") == F.lit("head")), "left")
    same = F.lit(True)
    for k in key:
        same = same & (F.col(k) == F.col(f"_t_{k}"))
    effective = F.when(F.col("_kind") == F.lit("head"),
                       F.coalesce(same & F.col("_t_ins"), F.lit(False))).otherwise(F.col("_eff"))
    return joined.select(*key, F.col("_seq").alias(seq), effective.alias("effective"))
