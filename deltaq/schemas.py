"""Table layouts of the changelog: column names, Spark types, delete keys and arity.

A changelog line is ``OP|table|field1|field2|...``.  Fields are positional, so a layout is an
ordered list of (column, type).  Two layouts exist:

* ``REFERENCE`` - the full TPC-H layout (8 / 9 / 16 fields), the default for text changelogs.
* ``DRIVER`` - the columns present in the driver's parquet tables (5 / 6 / 11 fields); changelogs
  that we synthesise from those tables use it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
REVENUE = T.DecimalType(18, 4)

TYPE_SQL = {
    T.LongType(): "bigint",
    T.IntegerType(): "int",
    T.StringType(): "string",
    T.DateType(): "date",
    MONEY: "decimal(12,2)",
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...]

    @property
    def arity(self) -> int:
        return len(self.columns)

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def position(self, column: str) -> int:
        return self.names.index(column)

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns])


@dataclass(frozen=True)
class Layout:
    name: str
    tables: tuple[TableSpec, ...]

    def __getitem__(self, table: str) -> TableSpec:
        for spec in self.tables:
            if spec.name == table:
                return spec
        raise KeyError(table)

    @property
    def table_names(self) -> list[str]:
        return [t.name for t in self.tables]


_L, _I, _S, _D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()

# The TPC-H column order of the three tables and their delete keys.
REFERENCE = Layout("reference", (
    TableSpec("customer", (
        ("c_custkey", _L), ("c_name", _S), ("c_address", _S), ("c_nationkey", _I),
        ("c_phone", _S), ("c_acctbal", MONEY), ("c_mktsegment", _S), ("c_comment", _S),
    ), ("c_custkey",)),
    TableSpec("orders", (
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", MONEY),
        ("o_orderdate", _D), ("o_orderpriority", _S), ("o_clerk", _S), ("o_shippriority", _I),
        ("o_comment", _S),
    ), ("o_orderkey",)),
    TableSpec("lineitem", (
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
        ("l_quantity", MONEY), ("l_extendedprice", MONEY), ("l_discount", MONEY), ("l_tax", MONEY),
        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _D), ("l_commitdate", _D),
        ("l_receiptdate", _D), ("l_shipinstruct", _S), ("l_shipmode", _S), ("l_comment", _S),
    ), ("l_orderkey", "l_linenumber")),
))

# The driver's parquet tables carry a subset of the columns, in this order.
DRIVER = Layout("driver", (
    TableSpec("customer", (
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", MONEY),
        ("c_mktsegment", _S),
    ), ("c_custkey",)),
    TableSpec("orders", (
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", MONEY),
        ("o_orderdate", _D), ("o_orderpriority", _S),
    ), ("o_orderkey",)),
    TableSpec("lineitem", (
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
        ("l_quantity", MONEY), ("l_extendedprice", MONEY), ("l_discount", MONEY), ("l_tax", MONEY),
        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _D),
    ), ("l_orderkey", "l_linenumber")),
))

OPS = ("INSERT", "DELETE")

# Result of the flagship query.
RESULT_COLUMNS = ("l_orderkey", "o_orderdate", "o_shippriority", "revenue")
RESULT_SCHEMA = T.StructType([
    T.StructField("l_orderkey", _L, True),
    T.StructField("o_orderdate", _D, True),
    T.StructField("o_shippriority", _I, True),
    T.StructField("revenue", REVENUE, True),
])
