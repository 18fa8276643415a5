"""Folders on whatever file system the session's paths are on (Hadoop FileSystem API).

``publish`` makes a written table appear at its final place in one step, or not at all: it is
written beside it and renamed.  A reader that watches the final place therefore sees each table
once, whatever is retried.  (A rename of a folder is atomic on HDFS and local disks; on object
stores use a committer-backed or versioned location for these few folders.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Codec of the tables written between steps: they are read a few times at most.
CODEC = "zstd"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as listings spell it."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def make_dirs(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"cannot make folder {path}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none when it is absent)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def publish(df: DataFrame, staging: str, final: str) -> bool:
    """Write ``df`` to ``staging`` and rename it to ``final``; False when it is there already."""
    spark = df.sparkSession
    target, fs = _fs(spark, final)
    if fs.exists(target):
        return False
    df.write.mode("overwrite").parquet(staging, compression=CODEC)
    fs.mkdirs(target.getParent())
    source, _ = _fs(spark, staging)
    if not fs.rename(source, target) and not fs.exists(target):
        raise OSError(f"cannot publish {final}")
    return True
