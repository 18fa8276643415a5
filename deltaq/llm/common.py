"""Small helpers shared by the operators: tables, shared scratch tables, checks of rows."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from deltaq.session import work_dir

#: Words everywhere in this package: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers (once per application): Spark itself
    hands the archive to every executor, so it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="deltaq-")) / "deltaq.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


_SHIPPED: set[str] = set()


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: lineage ends there, so a
    lost executor costs a re-read, never a recomputation."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}") + "/table"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hand_back() -> None:
    """Give memory that a finished task has freed back to the system: a Python worker lives on for
    the tasks of later stages, which share an executor's memory with it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # where the C library is another
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def batches(columns: dict[str, pa.DataType], rows: Iterable[tuple],
            size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows from an iterator of tuples."""
    schema = pa.schema(list(columns.items()))
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*held)) if held else [()] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield flush()
            held = []
    if held:
        yield flush()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit integers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
