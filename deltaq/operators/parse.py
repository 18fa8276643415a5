"""Validate, normalise and route changelog lines.

``parse`` splits each line once and attaches a ``reason`` (NULL when the line is accepted); the
first failing rule wins, in this order:

    blank          nothing left after stripping the line              (B1)
    too_few_parts  fewer than 3 ``|``-separated parts                 (B3)
    unknown_table  table name, lower-cased, is not in the layout      (B6)
    bad_arity      field count differs from the table's column count  (B4)
    unknown_op     op, upper-cased, is neither INSERT nor DELETE      (B5)
    bad_value      a typed field does not convert (B18, quarantine policy); a DELETE is only
                   checked on its key fields, as only the key is used

``parse`` does all of it in one pass: it splits each line once, converts the fields of the line's
own table once, and gives every line its verdict.  ``route`` projects the accepted lines of one
table onto its typed columns (B7-B10).  Bad lines go to ``quarantine`` with their reason instead of
a log warning (B17).  Everything is one projection per row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import strip_line
from ..schemas import DRIVER, OPS, Layout

QUARANTINE = "quarantine"
FAIL = "fail"


def _field(i: int) -> Column:
    """Field ``i`` (0-based, after op and table) of the split line."""
    return F.try_element_at(F.col("_parts"), F.lit(i + 3))


def _once(*cols: Column) -> Column:
    """Compute ``cols`` once per row as generator output.

    Predicate pushdown substitutes projected expressions into every filter that refers to them;
    for the split line and its typed fields that would repeat the work dozens of times per row.
    Filters cannot move below a generator that produces the columns they read, so a one-row
    ``inline`` pins the computation in place (it stays in whole-stage codegen).
    """
    return F.inline(F.array(F.struct(*cols)))


def _typed_fields(layout: Layout, valid: Column, strict: bool) -> list[Column]:
    """The typed columns of every table; null where the line is another table's or invalid."""
    cols = []
    for spec in layout.tables:
        own = valid & (F.col("tbl") == F.lit(spec.name))
        for i, (name, dtype) in enumerate(spec.columns):
            f = _field(i)
            if not isinstance(dtype, T.StringType):
                f = f.cast(dtype) if strict else f.try_cast(dtype)
            cols.append(F.when(own, f).alias(name))
    return cols


def _bad_value(layout: Layout) -> Column:
    """An INSERT is bad if any typed field fails to convert, a DELETE only if a key does."""
    bad = F.lit(False)
    for spec in layout.tables:
        def any_null(names, spec=spec):
            out = F.lit(False)
            for c, t in spec.columns:
                if c in names and not isinstance(t, T.StringType):
                    out = out | F.col(c).isNull()
            return out
        own = F.when(F.col("op") == F.lit("DELETE"), any_null(spec.key)).otherwise(
            any_null(spec.names))
        bad = F.when(F.col("tbl") == F.lit(spec.name), own).otherwise(bad)
    return bad


def parse(lines: DataFrame, layout: Layout = DRIVER, value: str = "value",
          policy: str = QUARANTINE) -> DataFrame:
    """Add ``op``, ``tbl``, ``reason`` (null when accepted) and the typed columns of every table to
    each line.  With policy FAIL a field that does not convert raises instead."""
    parts = F.split(strip_line(value), r"\|", -1)
    given = lines.columns
    df = lines.select("*", _once(parts.alias("_parts")))
    df = (df.withColumn("op", F.upper(F.try_element_at(F.col("_parts"), F.lit(1))))
          .withColumn("tbl", F.lower(F.when(F.size("_parts") >= 2,
                                             F.try_element_at(F.col("_parts"), F.lit(2))))))
    expected = F.lit(None).cast("int")
    for spec in reversed(layout.tables):
        expected = F.when(F.col("tbl") == F.lit(spec.name), F.lit(spec.arity)).otherwise(expected)
    blank = (F.size("_parts") == 1) & (F.try_element_at(F.col("_parts"), F.lit(1)) == F.lit(""))
    reason = (F.when(blank, F.lit("blank"))
              .when(F.size("_parts") < 3, F.lit("too_few_parts"))
              .when(expected.isNull(), F.lit("unknown_table"))
              .when(F.size("_parts") - 2 != expected, F.lit("bad_arity"))
              .when(~F.col("op").isin(*OPS), F.lit("unknown_op")))
    df = df.withColumn("_why", reason)
    typed = _typed_fields(layout, F.col("_why").isNull(), strict=(policy == FAIL))
    df = df.select(*[F.col(c) for c in given if c not in ("op", "tbl")], "op", "tbl", "_why",
                   _once(*typed))
    why = F.coalesce("_why", F.when(_bad_value(layout), F.lit("bad_value")))
    return df.withColumn("reason", why).drop("_why")


def route(parsed: DataFrame, table: str, layout: Layout = DRIVER,
          passthrough: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Accepted lines of one table as typed rows ``(seq, op, columns...)``."""
    keep = [c for c in passthrough if c in parsed.columns]
    return (parsed.filter((F.col("tbl") == F.lit(table)) & F.col("reason").isNull())
            .select(*keep, "op", *layout[table].names))


def route_all(parsed: DataFrame, layout: Layout = DRIVER,
              passthrough: tuple[str, ...] = ("seq",)) -> dict[str, DataFrame]:
    return {t: route(parsed, t, layout, passthrough) for t in layout.table_names}


def verdicts(parsed: DataFrame, layout: Layout = DRIVER,
             keep: tuple[str, ...] = ("seq", "value")) -> DataFrame:
    """Every line once, with ``tbl``, ``op`` and ``reason`` (NULL = accepted)."""
    cols = [c for c in keep if c in parsed.columns]
    return parsed.select(*cols, "tbl", "op", "reason")


def quarantine(parsed: DataFrame, layout: Layout = DRIVER,
               keep: tuple[str, ...] = ("seq", "value")) -> DataFrame:
    """Rejected lines with the reason (the first rule they fail)."""
    return verdicts(parsed, layout, keep).filter(F.col("reason").isNotNull())
