"""Registry of the queries exposed through ``__spark_entry__``: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole driver tables of ``sf_dir`` (or data Spark derives from them, such
as a changelog synthesised from them), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import (
    hash_rank, ordered_before, revenue, segment_is, shipped_after)
from ..operators import parse as P
from ..operators import replay as R
from ..operators import running as U
from ..operators import synth as S
from ..params import DEFAULT
from ..schemas import DRIVER, REVENUE
from ..session import work_dir
from ..sources.changelog import read_changelog, write_changelog
from ..sources.tables import load_table, load_tables, with_shippriority
from . import changes as C
from . import oracle as O
from .q3 import colocate_items, q3, q3_colocated, q3_sql, read_sql_file, write_sql_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _q3_of(t: dict[str, DataFrame]) -> DataFrame:
    return q3(t["customer"], with_shippriority(t["orders"]), t["lineitem"], DEFAULT)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- flagship -----------------------------------------------------------------------------------

@register("q3_batch", O.Q3_BATCH)
def q3_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _q3_of(load_tables(spark, sf_dir))


@register("q3_filtered", O.Q3_BATCH)
def q3_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 as for an order side too large to broadcast: a bitmap of its keys reaches the line items
    before they are shuffled."""
    t = load_tables(spark, sf_dir)
    return q3(t["customer"], with_shippriority(t["orders"]), t["lineitem"], DEFAULT,
              broadcast_orders=-1)


@register("q3_colocated", O.Q3_BATCH)
def q3_colocated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 over tables bucketed on the order key: no exchange under the join."""
    t = load_tables(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return q3_colocated(t["customer"], with_shippriority(t["orders"]),
                        colocate_items(t["lineitem"], buckets), buckets)


@register("q3_sql", O.Q3_BATCH)
def q3_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return q3_sql(spark, t["customer"], with_shippriority(t["orders"]), t["lineitem"], DEFAULT)


@register("q3_sql_file", O.Q3_BATCH)
def q3_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 from a file: the query text is stored as a .sql file and read back before running."""
    path = work_dir(spark, "query_sql")
    write_sql_file(spark, path)
    t = load_tables(spark, sf_dir)
    return q3_sql(spark, t["customer"], with_shippriority(t["orders"]), t["lineitem"], DEFAULT,
                  text=read_sql_file(spark, path))


# --- typed tables, predicates, revenue, plain joins ---------------------------------------------

@register("typed_tables", O.with_typed(" UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(*) AS n, "
    f"CAST(sum({O.md5_bits(O.fields_sql(t), 10)}) AS DECIMAL(38,0)) AS checksum, "
    f"CAST(sum({m}) AS DECIMAL(18,2)) AS money FROM {src}"
    for (t, src), m in zip(O.SRC.items(), ("c_acctbal", "o_totalprice", "l_extendedprice")))))
def typed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: every typed column of every table, as an order-free checksum of all rows."""
    money = {"customer": "c_acctbal", "orders": "o_totalprice", "lineitem": "l_extendedprice"}
    t = load_tables(spark, sf_dir)
    return _union([t[n].agg(
        F.lit(n).alias("tbl"), F.count(F.lit(1)).alias("n"),
        F.sum(hash_rank(S.fields_text(t[n], n), 10).cast("decimal(38,0)"))
        .cast("decimal(38,0)").alias("checksum"),
        F.sum(m).cast("decimal(18,2)").alias("money")) for n, m in money.items()])


@register("filter_segment", O.with_typed(
    f"SELECT * FROM tc WHERE c_mktsegment = '{DEFAULT.segment}'"))
def filter_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "customer").filter(segment_is(DEFAULT))


@register("filter_order_date", O.with_typed(
    f"SELECT * FROM tor WHERE o_orderdate < {DEFAULT.order_date_sql}"))
def filter_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders").filter(ordered_before(DEFAULT))


@register("filter_ship_date", O.with_typed(
    f"SELECT * FROM tl WHERE l_shipdate > {DEFAULT.ship_date_sql}"))
def filter_ship_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem").filter(shipped_after(DEFAULT))


@register("item_revenue", O.with_typed(
    "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) "
    "AS item_revenue FROM tl"))
def item_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", revenue().cast(REVENUE).alias("item_revenue"))


@register("join_customer_orders", O.with_typed(
    "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice, c_name, "
    "c_nationkey, c_mktsegment FROM tor JOIN tc ON c_custkey = o_custkey"))
def join_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + B16: orders with their customer's fields (disjoint names, explicit projection)."""
    t = load_tables(spark, sf_dir)
    j = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner")
    return j.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice",
                    "c_name", "c_nationkey", "c_mktsegment")


# --- changelog synthesis ------------------------------------------------------------------------

@register("synth_changelog", O.with_rounds("SELECT seq, rnd, tbl, line FROM rc"))
def synth_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rounds(spark, sf_dir)


@register("synth_changelog_shuffled",
          f"WITH {O.TYPED_CTES.strip()},\n{O.shuffled_ctes()}\nSELECT seq, tbl, line FROM ranked")
def synth_changelog_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shuffled(load_tables(spark, sf_dir))


@register("synth_flip_deletes", f"""WITH {O.TYPED_CTES.strip()},
{O.shuffled_ctes()}
SELECT tbl, split_part(line, '|', 1) AS op, count(*) AS n,
  CAST(sum({O.md5_bits("line", 10)}) AS DECIMAL(38,0)) AS lines,
  CAST(sum(seq) AS DECIMAL(38,0)) AS places FROM sh GROUP BY ALL""")
def synth_flip_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines per table and operation, with order-free checksums of all lines and places."""
    flipped = C.flipped(spark, sf_dir)
    return flipped.groupBy("tbl", F.split_part("line", F.lit("|"), F.lit(1)).alias("op")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hash_rank(F.col("line"), 10).cast("decimal(38,0)")).cast("decimal(38,0)")
        .alias("lines"),
        F.sum(F.col("seq").cast("decimal(38,0)")).cast("decimal(38,0)").alias("places"))


# --- text changelog, validation, routing --------------------------------------------------------

@register("changelog_scan", O.with_rounds(
    "SELECT tbl, op, count(*) AS n FROM rc GROUP BY tbl, op"))
def changelog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = C.text_roundtrip(spark, C.rounds(spark, sf_dir), "changelog_scan")
    ok = P.verdicts(P.parse(lines, DRIVER), DRIVER, keep=()).filter(F.col("reason").isNull())
    return ok.groupBy("tbl", "op").agg(F.count(F.lit(1)).alias("n"))


def _damaged_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse(S.damage_lines(C.rounds(spark, sf_dir)).withColumnRenamed("line", "value"))


@register("changelog_quarantine", O.with_rounds(O.DAMAGE_BODY.format(select="""
    SELECT damage, reason, count(*) AS n FROM dmg GROUP BY damage, reason""")))
def changelog_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line's verdict, tallied by the kind of damage it received."""
    lines = P.verdicts(_damaged_parsed(spark, sf_dir), DRIVER, keep=("damage",))
    return lines.groupBy("damage", "reason").agg(F.count(F.lit(1)).alias("n"))


@register("changelog_audit", O.with_rounds(O.DAMAGE_BODY.format(select="""
    SELECT a_tbl AS tbl, a_op AS op, coalesce(reason, 'accepted') AS status, count(*) AS n
    FROM dmg GROUP BY ALL""")))
def changelog_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per (table, operation, status) as the router sees them."""
    parsed = P.verdicts(_damaged_parsed(spark, sf_dir), DRIVER, keep=())
    return (parsed.groupBy("tbl", "op", F.coalesce("reason", F.lit("accepted")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))


def _routes(spark: SparkSession, sf_dir: str, tables: list[str] | None = None,
            ) -> dict[str, DataFrame]:
    """Rounds changelog, parsed once into a bronze table, routed per table from its partition."""
    return C.routed(C.staged(spark, C.parsed_lines(C.rounds(spark, sf_dir)), "bronze",
                             tables=tables))


for _t in ("customer", "orders", "lineitem"):
    def _route(spark: SparkSession, sf_dir: str, _t=_t) -> DataFrame:
        return _routes(spark, sf_dir, [_t])[_t]
    register(f"route_{_t}", O.with_rounds(
        f"SELECT seq, op, {', '.join(DRIVER[_t].names)} FROM rc_{_t}"))(_route)


@register("signed_changes", O.with_rounds(O.SIGNED_BODY))
def signed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.signed(_routes(spark, sf_dir))


# --- replay -------------------------------------------------------------------------------------

for _t in ("customer", "orders", "lineitem"):
    def _replay(spark: SparkSession, sf_dir: str, _t=_t) -> DataFrame:
        return C.replayed({_t: _routes(spark, sf_dir, [_t])[_t]})[_t]
    _extra = ", CAST(0 AS INTEGER) AS o_shippriority" if _t == "orders" else ""
    register(f"replay_{_t}", O.with_rounds(f"SELECT *{_extra} FROM live_{_t}", live=True))(_replay)


@register("noop_deletes", O.with_rounds(O.NOOP_BODY))
def noop_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELETEs that find nothing live for their key, per table."""
    routes = _routes(spark, sf_dir)
    parts = []
    for t, df in routes.items():
        eff = R.delete_effects(df, DRIVER[t].key)
        parts.append(eff.agg(F.lit(t).alias("tbl"), F.count(F.lit(1)).alias("deletes"),
                             F.count(F.when(~F.col("effective"), 1)).alias("noop")))
    return _union(parts)


@register("running_revenue_by_change", O.with_rounds(O.BY_CHANGE, live=True))
def running_revenue_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line-item change that takes effect on an order of the flagship query (live,
    before its date, of a live customer in the segment), with the order's revenue after it."""
    routes = _routes(spark, sf_dir)
    live = C.replayed({t: routes[t] for t in ("customer", "orders")})
    cust = live["customer"].filter(segment_is(DEFAULT)).select("c_custkey")
    orders = live["orders"].filter(ordered_before(DEFAULT)).join(
        cust, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    effects = U.line_item_effects(routes["lineitem"], DRIVER["lineitem"].key)
    effects = effects.join(orders.select("o_orderkey", "o_orderdate", "o_shippriority"),
                           F.col("l_orderkey") == F.col("o_orderkey"))
    return U.running_revenue(effects, ["l_orderkey", "o_orderdate", "o_shippriority"]).select(
        "l_orderkey", "o_orderdate", "o_shippriority", "l_linenumber", "seq", "op", "revenue",
        "live")


@register("active_counts", O.with_rounds(O.ACTIVE_BODY, live=True))
def active_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live copies per key, all three tables."""
    live = C.replayed(_routes(spark, sf_dir))
    parts = []
    for t, df in live.items():
        key = DRIVER[t].key
        k2 = F.col(key[1]) if len(key) > 1 else F.lit(None).cast("int")
        parts.append(R.live_counts(df, key).select(
            F.lit(t).alias("tbl"), F.col(key[0]).alias("k1"), k2.alias("k2"), "live"))
    return _union(parts)


@register("semi_join_active_orders", O.with_rounds(f"""
SELECT *, CAST(0 AS INTEGER) AS o_shippriority FROM live_orders o
WHERE EXISTS (SELECT 1 FROM live_customer c WHERE c.c_custkey = o.o_custkey
              AND c.c_mktsegment = '{DEFAULT.segment}')""", live=True))
def semi_join_active_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live orders whose customer is live and in the segment (left semi join)."""
    live = C.replayed(_routes(spark, sf_dir))
    cust = live["customer"].filter(segment_is(DEFAULT)).select("c_custkey")
    return live["orders"].join(cust, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@register("replay_q3", O.with_rounds(O.q3_over("cf_customer", "cf_orders", "cf_lineitem"),
                                     closed=True))
def replay_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text changelog -> parse -> route -> replay -> flagship query."""
    lines = C.text_roundtrip(spark, C.rounds(spark, sf_dir), "replay_q3")
    live = C.replayed(C.routed(C.staged(spark, P.parse(lines, DRIVER), "replay_q3_bronze")))
    return _q3_of(live)


@register("replay_appended_q3", O.with_rounds(
    O.q3_over("live_customer", "live_orders", "live_lineitem"), live=True))
def replay_appended_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog appended round by round (A5), read back in the order of its batches and parts
    (A1), replayed, then the flagship query."""
    path = work_dir(spark, "replay_appended")
    for r in range(len(S.ROUND_OPS)):
        write_changelog(C.rounds(spark, sf_dir, only=r), path, mode="append")
    lines = read_changelog(spark, path)
    live = C.replayed(C.routed(C.staged(spark, P.parse(lines, DRIVER), "appended_bronze")))
    return _q3_of(live)


@register("replay_flipped_q3", O.FLIPPED_Q3)
def replay_flipped_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled changelog with DELETE-flipped lines, replayed, then the flagship query."""
    parsed = C.parsed_lines(C.flipped(spark, sf_dir))
    live = C.replayed(C.routed(C.staged(spark, parsed, "flipped_bronze")))
    return _q3_of(live)


# --- incremental path ---------------------------------------------------------------------------

from . import incremental as INC  # noqa: E402

_CLOSED_Q3 = O.with_rounds(O.q3_over("cf_customer", "cf_orders", "cf_lineitem"), closed=True)

register("stream_q3", _CLOSED_Q3)(INC.stream_q3)
register("stream_keyed_q3", _CLOSED_Q3)(INC.stream_keyed_q3)
register("stream_semi_join_orders", O.with_rounds(f"""
SELECT o_orderkey, o_custkey, o_orderdate, count(*) AS w FROM cf_orders
WHERE o_orderdate < {DEFAULT.order_date_sql} AND o_custkey IN (
  SELECT c_custkey FROM cf_customer WHERE c_mktsegment = '{DEFAULT.segment}' UNION ALL
  SELECT c_custkey FROM tc WHERE c_mktsegment = '{DEFAULT.segment}'
    AND ({INC.REPEATED['customer']}))
GROUP BY o_orderkey, o_custkey, o_orderdate""", closed=True))(INC.stream_semi_join_orders)
register("incremental_revenue", _CLOSED_Q3)(INC.incremental_revenue)
register("latest_per_key", _CLOSED_Q3)(INC.latest_per_key)
register("stream_running_revenue", O.RUNNING)(INC.running_updates)
register("drop_dead_groups", O.with_rounds(
    "SELECT l_orderkey, o_orderdate, o_shippriority FROM (" + O.q3_over("tc", "tor", "tl")
    + ") EXCEPT SELECT l_orderkey, o_orderdate, o_shippriority FROM ("
    + O.q3_over("cf_customer", "cf_orders", "cf_lineitem") + ")", closed=True))(
    INC.drop_dead_groups)
register("stream_join_customer_orders", O.with_rounds(f"""
SELECT o_orderkey, o_custkey, o_orderdate, count(*) AS w
FROM cf_orders JOIN cf_customer ON c_custkey = o_custkey
WHERE c_mktsegment = '{DEFAULT.segment}' AND o_orderdate < {DEFAULT.order_date_sql}
GROUP BY o_orderkey, o_custkey, o_orderdate""", closed=True))(INC.stream_join_customer_orders)

for _t in ("customer", "orders", "lineitem"):
    def _norm(spark: SparkSession, sf_dir: str, _t=_t) -> DataFrame:
        return INC.stream_normalized(spark, sf_dir, _t)
    _cols = ", ".join(DRIVER[_t].names)
    register(f"stream_normalize_{_t}", O.with_rounds(
        f"SELECT {_cols}, count(*) AS w FROM cf_{_t} GROUP BY {_cols}", closed=True))(_norm)


# --- files and reconciliation -------------------------------------------------------------------

from ..operators import reconcile as E  # noqa: E402
from ..operators import reconcile_tree as T  # noqa: E402
from ..sources import files as FS  # noqa: E402


@register("tbl_roundtrip", O.with_typed(" UNION ALL ".join(
    f"SELECT '{t}' AS tbl, {O.fields_sql(t)} AS fields FROM {src}" for t, src in O.SRC.items())))
def tbl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 then A2: every table exported as ``|``-separated text and scanned back typed."""
    parts = []
    for t, df in load_tables(spark, sf_dir).items():
        path = work_dir(spark, "tbl")
        FS.write_tbl(df, path)
        back = FS.read_tbl(spark, path, t)
        parts.append(back.select(F.lit(t).alias("tbl"), S.fields_text(back, t).alias("fields")))
    return _union(parts)


@register("result_csv_roundtrip", O.Q3_BATCH)
def result_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 then A7: the flagship result written as CSV text and read back."""
    path = work_dir(spark, "result_csv")
    FS.write_result_csv(q3_batch(spark, sf_dir), path)
    return FS.read_result_csv(spark, path)


def _reconciled(spark: SparkSession, sf_dir: str) -> E.Reconciliation:
    """Expected: the flagship on the base tables.  Actual: on the tables after the rounds."""
    expected = q3_batch(spark, sf_dir)
    actual = _q3_of(C.replayed(_routes(spark, sf_dir)))
    return E.reconcile(expected, actual)


_EXP = O.q3_over("tc", "tor", "tl")
_ACT = O.q3_over("cf_customer", "cf_orders", "cf_lineitem")
_SETS = f", exp AS ({_EXP}), act AS ({_ACT})\n"

register("reconcile_missing", O.with_rounds(
    _SETS + "SELECT * FROM exp EXCEPT SELECT * FROM act", closed=True))(
    lambda spark, sf_dir: _reconciled(spark, sf_dir).missing)
register("reconcile_extra", O.with_rounds(
    _SETS + "SELECT * FROM act EXCEPT SELECT * FROM exp", closed=True))(
    lambda spark, sf_dir: _reconciled(spark, sf_dir).extra)
register("reconcile_matching", O.with_rounds(
    _SETS + "SELECT * FROM exp INTERSECT SELECT * FROM act", closed=True))(
    lambda spark, sf_dir: _reconciled(spark, sf_dir).matching)
_SUMMARY = O.with_rounds(_SETS + """,
cnt AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM exp)) AS n_expected,
               (SELECT count(*) FROM (SELECT DISTINCT * FROM act)) AS n_actual,
               (SELECT count(*) FROM (SELECT * FROM exp INTERSECT SELECT * FROM act)) AS n_matching)
SELECT n_expected, n_actual, n_matching, n_expected - n_matching AS n_missing,
       n_actual - n_matching AS n_extra,
       CASE WHEN n_expected > 0 AND n_actual > 0
            THEN CAST(n_matching AS DOUBLE) * CAST(100.0 AS DOUBLE)
                 / CAST(greatest(n_expected, n_actual) AS DOUBLE)
            WHEN n_expected > 0 OR n_actual > 0 THEN CAST(0.0 AS DOUBLE) END AS accuracy,
       n_expected = n_matching AND n_actual = n_matching AS identical
FROM cnt""", closed=True)
register("reconcile_summary", _SUMMARY)(
    lambda spark, sf_dir: _reconciled(spark, sf_dir).summary())


@register("reconcile_tree_summary", _SUMMARY)
def reconcile_tree_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5, E7 by a tree of checksums over order keys: the flagship's result before and after the
    rounds; only ranges that differ are compared row by row."""
    expected = R.stored(q3_batch(spark, sf_dir), "tree_before")
    actual = R.stored(_q3_of(C.replayed(_routes(spark, sf_dir))), "tree_after")
    return T.reconcile_tree(expected, actual, "l_orderkey", sets=True).summary()


@register("reconcile_tree_lineitem", O.with_rounds("""
SELECT 'missing' AS side, * FROM (SELECT * FROM tl EXCEPT SELECT * FROM cf_lineitem)
UNION ALL
SELECT 'extra' AS side, * FROM (SELECT * FROM cf_lineitem EXCEPT SELECT * FROM tl)""", closed=True))
def reconcile_tree_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E3 on the largest table: line items before the rounds against those live after them, by a
    tree of checksums over order keys."""
    before = load_table(spark, sf_dir, "lineitem")
    live = C.replayed({"lineitem": _routes(spark, sf_dir, ["lineitem"])["lineitem"]})["lineitem"]
    after = R.stored(live.select(*before.columns), "tree_after")
    r = T.reconcile_tree(before, after, "l_orderkey")
    return r.missing.select(F.lit("missing").alias("side"), "*").unionByName(
        r.extra.select(F.lit("extra").alias("side"), "*"))


@register("reconcile_preview", O.with_rounds(_SETS + """,
diffs AS (SELECT 'missing' AS side, * FROM (SELECT * FROM exp EXCEPT SELECT * FROM act)
          UNION ALL
          SELECT 'extra' AS side, * FROM (SELECT * FROM act EXCEPT SELECT * FROM exp)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY side
                     ORDER BY l_orderkey, o_orderdate, o_shippriority, revenue) AS rn,
                  count(*) OVER (PARTITION BY side) AS n FROM diffs)
SELECT side, rn, l_orderkey, o_orderdate, o_shippriority, revenue,
       n - CASE WHEN n <= 10 THEN n ELSE 5 END AS remaining
FROM ranked WHERE rn <= CASE WHEN n <= 10 THEN n ELSE 5 END""", closed=True))
def reconcile_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted preview of both difference sets."""
    r = _reconciled(spark, sf_dir)
    return E.preview(r.missing, "missing").unionByName(E.preview(r.extra, "extra"))

register("stream_live_audit", O.with_rounds(
    "SELECT tbl, op, 'accepted' AS status, count(*) AS n FROM rc GROUP BY tbl, op"))(
    INC.stream_live_audit)
register("stream_audit", O.with_rounds(
    "SELECT tbl, op, 'accepted' AS status, count(*) AS n FROM rc GROUP BY tbl, op"))(
    INC.stream_audit)
