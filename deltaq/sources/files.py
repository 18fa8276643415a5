"""Delimited table files (A2, A3) and the result CSV.

``.tbl`` files: ``|``-separated, no header, no quoting, no trailing ``|``; read with an explicit
schema (no inference).  Result CSV: header ``l_orderkey, o_orderdate, o_shippriority, revenue``,
cells separated by comma and space, revenue as plain text with 4 decimals.  Both are ordinary
Spark CSV writes and reads, so they split across tasks and files like any other scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import money_text, to_revenue
from ..schemas import DRIVER, RESULT_COLUMNS, Layout

RESULT_SEP = ", "


def write_tbl(df: DataFrame, path: str) -> None:
    """A3: ``|``-separated export; NULL becomes the empty field."""
    (df.write.mode("overwrite").option("sep", "|").option("header", False)
     .option("quote", "").option("emptyValue", "").option("nullValue", "")
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_tbl(spark: SparkSession, path: str, table: str, layout: Layout = DRIVER) -> DataFrame:
    """A2: ``|``-separated scan with the table's schema."""
    return (spark.read.schema(layout[table].struct()).option("sep", "|").option("header", False)
            .option("quote", "").option("mode", "PERMISSIVE").option("dateFormat", "yyyy-MM-dd")
            .csv(path))


def write_result_csv(result: DataFrame, path: str) -> None:
    """A6 + D9: the result as CSV text; one header per part file."""
    cols = [money_text(c).alias(c) if c == "revenue" else F.col(c) for c in RESULT_COLUMNS]
    (result.select(*cols).write.mode("overwrite").option("header", True)
     .option("sep", RESULT_SEP).option("quote", "").option("dateFormat", "yyyy-MM-dd")
     .csv(path))


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trims cells, skips rows of the wrong width or with unconvertible cells, and rounds
    revenue HALF_UP to 4 decimals."""
    raw_schema = T.StructType([T.StructField(c, T.StringType()) for c in RESULT_COLUMNS])
    raw = (spark.read.schema(raw_schema).option("header", True).option("sep", ",")
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
           .option("mode", "DROPMALFORMED").csv(path))
    typed = raw.select(
        F.trim("l_orderkey").try_cast("bigint").alias("l_orderkey"),
        F.trim("o_orderdate").try_cast("date").alias("o_orderdate"),
        F.trim("o_shippriority").try_cast("int").alias("o_shippriority"),
        to_revenue(F.trim("revenue").try_cast("decimal(38,10)")).alias("revenue"))
    return typed.na.drop(how="any")
