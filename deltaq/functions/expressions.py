"""Column expressions shared by the batch and streaming forms (all built-in, JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Q3Params
from ..schemas import REVENUE

# Characters stripped from both ends of a changelog line (what Python's ``str.strip`` removes
# from ASCII text).
LINE_BLANKS = " \t\r\n\x0b\x0c"


def strip_line(col: str | Column) -> Column:
    """The line without blanks at its ends; ``btrim`` looks at every character, so it is left out
    where neither end has one."""
    c = F.col(col) if isinstance(col, str) else col
    ends = F.least(F.ascii(c), F.ascii(F.right(c, F.lit(1))))
    return F.when(ends > F.lit(ord(" ")), c).otherwise(F.btrim(c, F.lit(LINE_BLANKS)))


def revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Exact decimal ``price * (1 - discount)``."""
    return F.col(price) * (F.lit(1) - F.col(discount))


def to_revenue(col: Column) -> Column:
    """Round HALF_UP to 4 decimals and fix the type on both engines."""
    return F.round(col, 4).cast(REVENUE)


def weight(op: str = "op") -> Column:
    """An INSERT counts +1, a DELETE -1."""
    return F.when(F.col(op) == F.lit("INSERT"), F.lit(1)).otherwise(F.lit(-1))


def segment_is(params: Q3Params, col: str = "c_mktsegment") -> Column:
    """Case-sensitive segment equality."""
    return F.col(col) == F.lit(params.segment)


def ordered_before(params: Q3Params, col: str = "o_orderdate") -> Column:
    """Strict ``order date < threshold``."""
    return F.col(col) < F.lit(params.order_date)


def shipped_after(params: Q3Params, col: str = "l_shipdate") -> Column:
    """Strict ``ship date > threshold``."""
    return F.col(col) > F.lit(params.ship_date)


def money_text(col: str | Column) -> Column:
    """Plain (non-scientific) text of a decimal."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def hash_rank(text: Column, hex_digits: int = 15) -> Column:
    """A reproducible 60-bit number from md5 of a text (same value in DuckDB)."""
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")
