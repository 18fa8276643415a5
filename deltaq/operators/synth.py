"""Changelog synthesis from ordinary tables (F1-F4) and its text form (A5 lines).

A change is ``(seq, line)`` where ``line`` is ``OP|table|field1|...``.  ``seq`` orders changes;
it is derived from md5 of the line so that Spark and DuckDB agree on it, and no global sort or
row numbering is needed to assign it.

* ``insert_lines``  (F1)  every row of each table as an INSERT line.
* ``shuffled``      (F2)  seq = md5 rank of the line: a reproducible permutation.
* ``flip_deletes``  (F3)  the ``n`` lines with the smallest second md5 rank become DELETE.
* ``round_changes`` (F4)  rounds of inserts and deletes chosen by key rules (one scan per
  table: every row is expanded into the rounds it takes part in with ``explode``).
* ``damage_lines``  rewrites a deterministic share of lines into the malformed forms the
  validator must set aside, to exercise the quarantine over whole changelogs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import hash_rank
from ..schemas import DRIVER, Layout

# The four rounds of the deterministic changelog (operation, then per table the
# rule that picks the rows of that round).  Round 0 deletes rows that are only inserted later
# (a no-op), round 1 inserts everything, round 2 deletes, round 3 re-inserts part of it.
ROUND_OPS = ("DELETE", "INSERT", "DELETE", "INSERT")
ROUND_RULES: Mapping[str, Sequence[str]] = {
    "customer": ("c_custkey % 11 = 4", "TRUE", "c_custkey % 10 = 3", "c_custkey % 20 = 3"),
    "orders": ("o_orderkey % 11 = 4", "TRUE", "o_orderkey % 7 = 2", "o_orderkey % 14 = 2"),
    "lineitem": ("l_orderkey % 11 = 4", "TRUE",
                 "l_orderkey % 5 = 1 AND l_linenumber % 2 = 0",
                 "l_orderkey % 10 = 1 AND l_linenumber % 4 = 0"),
}

# seq of a round change: round in the high bits, 40 bits of md5 of the line below.
ROUND_SHIFT = 1 << 40
ROUND_HASH_DIGITS = 10
# Fixed value: how many lines the shuffled changelog turns into DELETEs, unless a share is given.
FLIP_COUNT = 1000


def fields_text(df: DataFrame, table: str, layout: Layout = DRIVER) -> Column:
    """``field1|field2|...`` of a typed row; NULL becomes the empty field."""
    spec = layout[table]
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.names])


def line_of(op: Column | str, table: str, fields: Column) -> Column:
    op_c = F.lit(op) if isinstance(op, str) else op
    return F.concat_ws("|", op_c, F.lit(table), fields)


def insert_lines(tables: Mapping[str, DataFrame], layout: Layout = DRIVER) -> DataFrame:
    """(tbl, line) for every row of every table, tagged INSERT, as one UNION ALL."""
    parts = [df.select(F.lit(t).alias("tbl"),
                       line_of("INSERT", t, fields_text(df, t, layout)).alias("line"))
             for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shuffled(tables: Mapping[str, DataFrame], layout: Layout = DRIVER) -> DataFrame:
    """(seq, tbl, line); the order by seq is a reproducible shuffle of all INSERT lines."""
    lines = insert_lines(tables, layout)
    return lines.select(hash_rank(F.col("line")).alias("seq"), "tbl", "line")


def flip_rank(line: Column) -> Column:
    return hash_rank(F.concat(F.lit("flip|"), line))


def flip_deletes(changes: DataFrame, n: int = FLIP_COUNT, share: float | None = None,
                 ) -> DataFrame:
    """turn the ``n`` lines of smallest flip rank from INSERT into DELETE, or about a given
    ``share`` of all lines, which grows with the changelog.

    The threshold for ``n`` is a scalar subquery over a top-``n`` (TakeOrderedAndProject keeps n
    rows per task), for a share a constant; so no row leaves its partition and no join is needed.
    Only the op field changes.
    """
    ranked = changes.withColumn("_flip", flip_rank(F.col("line")))
    if share is None:
        threshold = ranked.select("_flip").orderBy("_flip").limit(n).agg(F.max("_flip")).scalar()
    else:
        threshold = F.lit(int(share * (1 << 60)) - 1)
    flip = F.col("_flip") <= threshold
    new_line = F.when(flip, F.concat(F.lit("DELETE"), F.expr("substring(line, 7)"))) \
        .otherwise(F.col("line"))
    return ranked.withColumn("line", new_line).drop("_flip")


def round_changes(tables: Mapping[str, DataFrame], layout: Layout = DRIVER,
                  rules: Mapping[str, Sequence[str]] = ROUND_RULES,
                  ops: Sequence[str] = ROUND_OPS, only: int | None = None) -> DataFrame:
    """(seq, rnd, tbl, line) for the rounds; seq grows with the round.  For the round ``only``,
    the other rows of the tables are left out at the scan."""
    parts = []
    for t, df in tables.items():
        if only is not None:
            parts.append(df.filter(rules[t][only]).select(
                F.lit(only).alias("rnd"), F.lit(t).alias("tbl"),
                line_of(ops[only], t, fields_text(df, t, layout)).alias("line")))
            continue
        steps = F.array(*[
            F.struct(F.lit(r).alias("rnd"), F.lit(op).alias("op"),
                     F.expr(rules[t][r]).alias("keep"))
            for r, op in enumerate(ops)])
        picked = df.select(fields_text(df, t, layout).alias("_f"),
                           F.explode(F.filter(steps, lambda s: s["keep"])).alias("_s"))
        parts.append(picked.select(
            F.col("_s.rnd").alias("rnd"), F.lit(t).alias("tbl"),
            line_of(F.col("_s.op"), t, F.col("_f")).alias("line")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    seq = (F.col("rnd").cast("bigint") * F.lit(ROUND_SHIFT)
           + hash_rank(F.col("line"), ROUND_HASH_DIGITS))
    return out.select(seq.alias("seq"), "rnd", "tbl", "line")


# The damage classes (md5 rank of the line modulo 16 picks one; others stay).
DAMAGE_CLASSES = 16
DAMAGE = {
    0: "blank",            # the line becomes empty
    1: "drop_last_field",  # one field fewer than the table has
    2: "extra_field",      # one field more
    3: "lower_op",         # op in lower case (accepted)
    4: "title_table",      # table name capitalised (accepted)
    5: "unknown_op",       # op UPSERT
    6: "unknown_table",    # table name 'part'
    7: "bad_key",          # key field not a number
    8: "op_only",          # only the op is left
    9: "padded",           # surrounding blanks (accepted after stripping)
}


def damage_lines(changes: DataFrame, line: str = "line") -> DataFrame:
    """Rewrite a deterministic share of lines into malformed or oddly-cased forms.

    Adds ``damage`` (the class name or NULL).  Works per row; no shuffle.
    """
    cls = F.pmod(hash_rank(F.concat(F.lit("damage|"), F.col(line))), F.lit(DAMAGE_CLASSES))
    parts = F.split(F.col(line), r"\|", -1)
    n = F.size(parts)
    rest = F.expr(f"substring({line}, instr({line}, '|') + 1)")          # table|fields
    fields = F.expr(f"substring({line}, length(split_part({line}, '|', 1)) + "
                    f"length(split_part({line}, '|', 2)) + 3)")         # fields only
    op = F.try_element_at(parts, F.lit(1))
    tbl = F.try_element_at(parts, F.lit(2))
    new = (F.when(cls == 0, F.lit(""))
           .when(cls == 1, F.array_join(F.slice(parts, 1, n - 1), "|"))
           .when(cls == 2, F.concat(F.col(line), F.lit("|extra")))
           .when(cls == 3, F.concat(F.lower(op), F.lit("|"), rest))
           .when(cls == 4, F.concat(op, F.lit("|"), F.initcap(tbl), F.lit("|"), fields))
           .when(cls == 5, F.concat(F.lit("UPSERT|"), rest))
           .when(cls == 6, F.concat(op, F.lit("|part|"), fields))
           .when(cls == 7, F.concat(op, F.lit("|"), tbl, F.lit("|k"), fields))
           .when(cls == 8, op)
           .when(cls == 9, F.concat(F.lit("  "), F.col(line), F.lit("\t ")))
           .otherwise(F.col(line)))
    name = F.try_element_at(F.create_map(*[x for k, v in DAMAGE.items()
                                       for x in (F.lit(k), F.lit(v))]), cls.cast("int"))
    return changes.withColumn("damage", name).withColumn(line, new)
