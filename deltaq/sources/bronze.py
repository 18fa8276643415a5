"""Bronze table: every changelog line once, typed, as parquet partitioned by table name.

The text is split and converted in one pass; an accepted line is kept as the typed columns of its
table (those of the other tables are null, which parquet stores for almost nothing), a rejected one
as its text and reason.  Afterwards each table is read from its own partition, only in the columns a
query needs, with filters pushed to the scan.  The table also cuts the lineage: a lost executor
re-reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DRIVER, Layout
from .changelog import SEQ_TYPE
from .storage import CODEC


# A task keeps a file open for each table, so that its rows need no sort by table (with all typed
# columns they are wide); beyond so many names of unknown tables Spark sorts as usual.
_WRITERS, _OPEN_TABLES = "spark.sql.maxConcurrentOutputFileWriters", "16"


def bronze_schema(layout: Layout = DRIVER, seq: str = SEQ_TYPE) -> str:
    fields = [f"{c} {t.simpleString()}" for spec in layout.tables for c, t in spec.columns]
    return f"seq {seq}, op string, reason string, value string, " + ", ".join(fields)


def write_bronze(parsed: DataFrame, path: str, layout: Layout = DRIVER, mode: str = "overwrite",
                 ) -> None:
    columns = [c for spec in layout.tables for c in spec.names]
    rejected = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    rows = parsed.select("seq", "op", "reason", rejected, *columns,
                         F.coalesce("tbl", F.lit("")).alias("tbl"))
    conf = parsed.sparkSession.conf
    before = conf.get(_WRITERS, None)
    conf.set(_WRITERS, _OPEN_TABLES)
    try:
        rows.write.mode(mode).partitionBy("tbl").parquet(path, compression=CODEC)
    finally:
        conf.unset(_WRITERS) if before is None else conf.set(_WRITERS, before)


def read_bronze(spark: SparkSession, path: str, layout: Layout = DRIVER, seq: str = SEQ_TYPE,
                batches: list[int] | None = None) -> DataFrame:
    """The bronze table, or of a stream's table (partitioned by batch ``b``) the given batches:
    only their folders are listed, and no schema is inferred."""
    schema = bronze_schema(layout, seq)
    if batches is None:
        df = spark.read.schema(f"{schema}, tbl string").parquet(path)
    elif batches:
        df = (spark.read.schema(f"{schema}, b int, tbl string").option("basePath", path)
              .parquet(*[f"{path}/b={b}" for b in batches]))
    else:
        df = spark.createDataFrame([], f"{schema}, b int, tbl string")
    return df.withColumn("tbl", F.when(F.col("tbl") != "", F.col("tbl")))
