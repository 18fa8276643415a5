"""Driver parquet tables, typed like the reference tables (A4 typed table load).

The driver's tables keep money as double and dates as ``timestamp_ntz``.  Every price in them has
exactly two decimals, so ``cast(... as decimal(12,2))`` is exact; dates are cast to ``date``.
``o_shippriority`` is absent and is added as ``0``.  All of it is projection only: Catalyst
prunes unused columns at the scan and the casts stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DRIVER, Layout

TPCH = ("customer", "orders", "lineitem")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def typed(df: DataFrame, table: str, layout: Layout = DRIVER) -> DataFrame:
    """Project ``df`` onto the layout's columns and types; missing ones come back NULL."""
    spec = layout[table]
    present = set(df.columns)
    cols = []
    for name, dtype in spec.columns:
        if name in present:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def load_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One driver table in the DRIVER layout (typed)."""
    return typed(read_raw(spark, sf_dir, table), table, DRIVER)


def load_tables(spark: SparkSession, sf_dir: str, share: float | None = None,
                ) -> dict[str, DataFrame]:
    """The typed tables, or a random ``share`` of their rows, taken before anything is converted."""
    if share is None:
        return {t: load_table(spark, sf_dir, t) for t in TPCH}
    return {t: typed(read_raw(spark, sf_dir, t).sample(share, seed=1), t, DRIVER) for t in TPCH}


def with_shippriority(orders: DataFrame) -> DataFrame:
    """The driver's orders have no ``o_shippriority``; the reference's only value is 0."""
    if "o_shippriority" in orders.columns:
        return orders
    return orders.withColumn("o_shippriority", F.lit(0).cast("int"))
