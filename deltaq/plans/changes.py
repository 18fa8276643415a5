"""Building blocks shared by the registered queries: changelogs made from the driver tables,
parsed and routed, replayed into live tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse as P
from ..operators import replay as R
from ..operators import synth as S
from ..schemas import DRIVER, Layout
from ..session import work_dir
from ..sources.bronze import read_bronze, write_bronze
from ..sources.changelog import read_changelog, write_changelog
from ..sources.tables import load_tables, with_shippriority


def rounds(spark: SparkSession, sf_dir: str, only: int | None = None, share: float | None = None,
           ) -> DataFrame:
    """F4 changelog ``(seq, rnd, tbl, line)`` over the whole driver tables, or one of its rounds; or
    that of a random ``share`` of their rows, which tells how ``seq`` is spread."""
    return S.round_changes(load_tables(spark, sf_dir, share), DRIVER, only=only)


def flipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F3 changelog ``(seq, tbl, line)``: every row inserted, shuffled, some turned DELETE."""
    return S.flip_deletes(S.shuffled(load_tables(spark, sf_dir), DRIVER))


def parsed_lines(changes: DataFrame, layout: Layout = DRIVER) -> DataFrame:
    return P.parse(changes.withColumnRenamed("line", "value"), layout)


def text_roundtrip(spark: SparkSession, changes: DataFrame, name: str) -> DataFrame:
    """Write the changelog as text (A5) in seq order and read it back (A1): ``(seq, value)``."""
    path = work_dir(spark, name)
    write_changelog(changes, path)
    return read_changelog(spark, path)


def staged(spark: SparkSession, parsed: DataFrame, name: str, layout: Layout = DRIVER,
           tables: list[str] | None = None) -> DataFrame:
    """Write parsed lines once as the typed bronze table (partitioned by table; only the given
    tables' lines, where some are enough) and read it back."""
    path = work_dir(spark, name)
    rows = parsed if tables is None else parsed.filter(F.col("tbl").isin(tables))
    write_bronze(rows, path, layout)
    return read_bronze(spark, path, layout, seq=dict(parsed.dtypes)["seq"])


def routed(parsed: DataFrame, layout: Layout = DRIVER) -> dict[str, DataFrame]:
    return P.route_all(parsed, layout)


def replayed(routes: dict[str, DataFrame], layout: Layout = DRIVER) -> dict[str, DataFrame]:
    """C1-C3 for every table; adds the missing o_shippriority to orders."""
    out = {t: R.live(df, layout[t].key) for t, df in routes.items()}
    if "orders" in out:
        out["orders"] = with_shippriority(out["orders"])
    return out


def signed(routes: dict[str, DataFrame], layout: Layout = DRIVER) -> DataFrame:
    """B14 over every table: ``(tbl, seq, k1, k2, w)``, w = +1 for INSERT, -1 for DELETE."""
    parts = []
    for t, df in routes.items():
        key = layout[t].key
        k2 = F.col(key[1]).cast("int") if len(key) > 1 else F.lit(None).cast("int")
        parts.append(df.select(F.lit(t).alias("tbl"), "seq", F.col(key[0]).alias("k1"),
                               k2.alias("k2"),
                               F.when(F.col("op") == "INSERT", 1).otherwise(-1).alias("w")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
