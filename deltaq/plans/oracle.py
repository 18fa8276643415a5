"""Independent DuckDB SQL for each registered query (the correctness gate).

The driver registers the raw parquet tables as views (``customer``, ``orders``, ``lineitem``,
...).  The CTEs below type them the same way ``sources.tables`` does, then each oracle states
its query plainly in SQL, without reusing the Spark code.
"""

from __future__ import annotations

from ..params import DEFAULT, Q3Params

TYPED_CTES = """
tc AS (SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
              CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer),
tor AS (SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority FROM orders),
tl AS (SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey,
              CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
              CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
              CAST(l_discount AS DECIMAL(12,2)) AS l_discount, CAST(l_tax AS DECIMAL(12,2)) AS l_tax,
              l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)
"""


def q3_over(cust: str, ords: str, items: str, p: Q3Params = DEFAULT) -> str:
    """The flagship query text over three relations (orders without o_shippriority -> 0)."""
    return f"""
SELECT l_orderkey, o_orderdate, CAST(0 AS INTEGER) AS o_shippriority,
       CAST(ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS DECIMAL(18,4)) AS revenue
FROM {items}, {cust}, {ords}
WHERE c_mktsegment = '{p.segment}'
  AND c_custkey = o_custkey AND l_orderkey = o_orderkey
  AND o_orderdate < {p.order_date_sql}
  AND l_shipdate > {p.ship_date_sql}
GROUP BY l_orderkey, o_orderdate
"""


def with_typed(body: str) -> str:
    return f"WITH {TYPED_CTES}\n{body}"


Q3_BATCH = with_typed(q3_over("tc", "tor", "tl"))


# ---------------------------------------------------------------------------------------------
# Changelog built in SQL from the same fixed round rules.

from ..operators.synth import FLIP_COUNT, ROUND_OPS, ROUND_RULES, ROUND_SHIFT  # noqa: E402
from ..schemas import DRIVER  # noqa: E402

SRC = {"customer": "tc", "orders": "tor", "lineitem": "tl"}
KEYS = {t: DRIVER[t].key for t in SRC}


def fields_sql(table: str) -> str:
    return "concat_ws('|', " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '')" for c in DRIVER[table].names) + ")"


def md5_bits(text: str, digits: int) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"


def rounds_ctes() -> str:
    """CTEs rc_<table> (rnd, op, seq, line, typed columns) and rc (rnd, tbl, op, seq, line)."""
    ctes = []
    for t, src in SRC.items():
        cols = ", ".join(DRIVER[t].names)
        branches = [
            f"SELECT {r} AS rnd, '{op}' AS op, '{op}|{t}|' || {fields_sql(t)} AS line, {cols} "
            f"FROM {src} WHERE {ROUND_RULES[t][r]}"
            for r, op in enumerate(ROUND_OPS)]
        ctes.append(f"rb_{t} AS ({' UNION ALL '.join(branches)})")
        ctes.append(f"rc_{t} AS (SELECT rnd, op, rnd * {ROUND_SHIFT} + {md5_bits('line', 10)} "
                    f"AS seq, line, {cols} FROM rb_{t})")
    ctes.append("rc AS (" + " UNION ALL ".join(
        f"SELECT rnd, '{t}' AS tbl, op, seq, line FROM rc_{t}" for t in SRC) + ")")
    return ",\n".join(ctes)


def live_ctes(prefix: str = "rc", exclude: str = "op, rnd, line") -> str:
    """CTEs live_<table>: INSERTs with no later DELETE of the same key (the SQL replay rule)."""
    ctes = []
    for t in SRC:
        key = KEYS[t]
        cond = " AND ".join(f"d.{k} = i.{k}" for k in key)
        ctes.append(
            f"live_{t} AS (SELECT i.* EXCLUDE ({exclude}) FROM {prefix}_{t} i WHERE i.op = 'INSERT' "
            f"AND NOT EXISTS (SELECT 1 FROM {prefix}_{t} d WHERE d.op = 'DELETE' AND {cond} "
            f"AND d.seq > i.seq))")
    return ",\n".join(ctes)


# Closed form of the live tables after the rounds: not deleted in round 2, or re-inserted in 3.
def closed_ctes() -> str:
    return ",\n".join(
        f"cf_{t} AS (SELECT * FROM {src} WHERE NOT ({ROUND_RULES[t][2]}) OR ({ROUND_RULES[t][3]}))"
        for t, src in SRC.items())


def with_rounds(body: str, live: bool = False, closed: bool = False) -> str:
    parts = [TYPED_CTES.strip(), rounds_ctes()]
    if live:
        parts.append(live_ctes())
    if closed:
        parts.append(closed_ctes())
    return "WITH " + ",\n".join(parts) + "\n" + body


def shuffled_ctes(n: int = FLIP_COUNT) -> str:
    """sh (seq, tbl, line): all INSERT lines, md5-ranked, the n smallest flip ranks as DELETE."""
    ins = " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, 'INSERT|{t}|' || {fields_sql(t)} AS line FROM {src}"
        for t, src in SRC.items())
    flip = md5_bits("'flip|' || line", 15)
    return (f"ins_lines AS ({ins}),\n"
            f"ranked AS (SELECT {md5_bits('line', 15)} AS seq, tbl, line, {flip} AS fr "
            f"FROM ins_lines),\n"
            f"thr AS (SELECT max(fr) AS t FROM (SELECT fr FROM ranked ORDER BY fr LIMIT {n})),\n"
            f"sh AS (SELECT seq, tbl, CASE WHEN fr <= (SELECT t FROM thr) "
            f"THEN 'DELETE' || substr(line, 7) ELSE line END AS line FROM ranked)")


# Damaged changelog: the damage class of each line and what the validator must say about it.
_DMG_CLS = md5_bits("'damage|' || line", 15) + " % 16"
DAMAGE_BODY = (
    ", dmg0 AS (SELECT tbl AS o_tbl, op AS o_op, " + _DMG_CLS + " AS cls FROM rc),\n"
    "dmg AS (SELECT CASE cls WHEN 0 THEN 'blank' WHEN 1 THEN 'drop_last_field' "
    "WHEN 2 THEN 'extra_field' WHEN 3 THEN 'lower_op' WHEN 4 THEN 'title_table' "
    "WHEN 5 THEN 'unknown_op' WHEN 6 THEN 'unknown_table' WHEN 7 THEN 'bad_key' "
    "WHEN 8 THEN 'op_only' WHEN 9 THEN 'padded' END AS damage,\n"
    "  CASE cls WHEN 0 THEN 'blank' WHEN 1 THEN 'bad_arity' WHEN 2 THEN 'bad_arity' "
    "WHEN 5 THEN 'unknown_op' WHEN 6 THEN 'unknown_table' WHEN 7 THEN 'bad_value' "
    "WHEN 8 THEN 'too_few_parts' END AS reason,\n"
    "  CASE WHEN cls IN (0, 8) THEN NULL WHEN cls = 6 THEN 'part' ELSE o_tbl END AS a_tbl,\n"
    "  CASE cls WHEN 0 THEN '' WHEN 5 THEN 'UPSERT' ELSE o_op END AS a_op FROM dmg0)\n"
    "{select}")

SIGNED_BODY = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, seq, {KEYS[t][0]} AS k1, "
    + (f"{KEYS[t][1]}" if len(KEYS[t]) > 1 else "CAST(NULL AS INTEGER)")
    + f" AS k2, CASE WHEN op = 'INSERT' THEN 1 ELSE -1 END AS w FROM rc_{t}"
    for t in SRC)

NOOP_BODY = (
    "SELECT tbl, count(*) AS deletes, count(*) FILTER (WHERE prev_op IS DISTINCT FROM 'INSERT') "
    "AS noop FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, op, lag(op) OVER (PARTITION BY {', '.join(KEYS[t])} ORDER BY seq) "
        f"AS prev_op FROM rc_{t}" for t in SRC)
    + ") WHERE op = 'DELETE' GROUP BY tbl")

# D4 per change: what each change adds or takes away (a DELETE: all that its key got since the
# DELETE before it), summed per order up to the change.
BY_CHANGE = f""",
ev AS (SELECT l_orderkey, l_linenumber, seq, op,
  CASE WHEN op = 'INSERT' AND l_shipdate > {DEFAULT.ship_date_sql}
       THEN l_extendedprice * (1 - l_discount) ELSE 0 END AS r,
  CASE WHEN op = 'INSERT' AND l_shipdate > {DEFAULT.ship_date_sql} THEN 1 ELSE 0 END AS c
  FROM rc_lineitem),
since AS (SELECT *, count(*) FILTER (WHERE op = 'DELETE') OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM ev),
eff AS (SELECT l_orderkey, l_linenumber, seq, op,
  CASE WHEN op = 'DELETE' THEN -sum(r) OVER part ELSE r END AS r,
  CASE WHEN op = 'DELETE' THEN -sum(c) OVER part ELSE c END AS c
  FROM since WINDOW part AS (PARTITION BY l_orderkey, l_linenumber, g))
SELECT l_orderkey, o_orderdate, CAST(0 AS INTEGER) AS o_shippriority, l_linenumber, eff.seq, op,
  CAST(sum(r) OVER total AS DECIMAL(18,4)) AS revenue, CAST(sum(c) OVER total AS BIGINT) AS live
FROM eff JOIN live_orders ON l_orderkey = o_orderkey
WHERE c <> 0 AND o_orderdate < {DEFAULT.order_date_sql} AND o_custkey IN (
  SELECT c_custkey FROM live_customer WHERE c_mktsegment = '{DEFAULT.segment}')
WINDOW total AS (PARTITION BY l_orderkey ORDER BY eff.seq)"""

ACTIVE_BODY = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, {KEYS[t][0]} AS k1, "
    + (f"{KEYS[t][1]}" if len(KEYS[t]) > 1 else "CAST(NULL AS INTEGER)")
    + f" AS k2, count(*) AS live FROM live_{t} GROUP BY {', '.join(KEYS[t])}"
    for t in SRC)


def flipped_ctes(n: int = FLIP_COUNT) -> str:
    """fl_<table> (seq, op, typed columns) of the shuffled changelog with flipped DELETEs."""
    ctes = []
    for t, src in SRC.items():
        cols = ", ".join(DRIVER[t].names)
        ctes.append(f"fb_{t} AS (SELECT 'INSERT|{t}|' || {fields_sql(t)} AS line, {cols} "
                    f"FROM {src})")
    flip = md5_bits("'flip|' || line", 15)
    ctes.append("fall AS (" + " UNION ALL ".join(
        f"SELECT {flip} AS fr FROM fb_{t}" for t in SRC) + ")")
    ctes.append(f"fthr AS (SELECT max(fr) AS t FROM (SELECT fr FROM fall ORDER BY fr LIMIT {n}))")
    for t in SRC:
        cols = ", ".join(DRIVER[t].names)
        ctes.append(f"fl_{t} AS (SELECT {md5_bits('line', 15)} AS seq, CASE WHEN {flip} <= "
                    f"(SELECT t FROM fthr) THEN 'DELETE' ELSE 'INSERT' END AS op, {cols} "
                    f"FROM fb_{t})")
    return ",\n".join(ctes)


FLIPPED_Q3 = ("WITH " + ",\n".join([TYPED_CTES.strip(), flipped_ctes(),
                                     live_ctes("fl", "op")])
              + "\n" + q3_over("live_customer", "live_orders", "live_lineitem"))


# Signed sums per join key and round (round 1 inserts every row, 2 takes some away, 3 brings
# some back), joined; a pair belongs to the latest round it comes from.  Per round: the groups it
# changed, with their sums over all pairs up to it.
def _signed_cte(name: str, table: str, where: str, group: str, sums: str) -> str:
    src, rules = SRC[table], ROUND_RULES[table]
    rows = " UNION ALL ".join(
        f"SELECT {b} AS b, {w} AS w, * FROM {src} WHERE ({rules[b]}) AND ({where})"
        for b, w in ((1, 1), (2, -1), (3, 1)))
    return f"{name} AS (SELECT b, {group}, {sums} FROM ({rows}) GROUP BY b, {group})"


RUNNING = ("WITH " + ",\n".join([
    TYPED_CTES.strip(),
    _signed_cte("sc", "customer", f"c_mktsegment = '{DEFAULT.segment}'", "c_custkey",
                "sum(w) AS cw"),
    _signed_cte("so", "orders", f"o_orderdate < {DEFAULT.order_date_sql}",
                "o_orderkey, o_custkey, o_orderdate", "sum(w) AS ow"),
    _signed_cte("sl", "lineitem", f"l_shipdate > {DEFAULT.ship_date_sql}", "l_orderkey",
                "sum(w * l_extendedprice * (1 - l_discount)) AS lrev, sum(w) AS lw"),
    """pairs AS (SELECT l_orderkey, o_orderdate, greatest(sc.b, so.b, sl.b) AS version,
  cw * ow * lw AS w, cw * ow * lrev AS wrev
  FROM sl JOIN so ON l_orderkey = o_orderkey JOIN sc ON o_custkey = c_custkey)""",
    "changed AS (SELECT DISTINCT l_orderkey, o_orderdate, version FROM pairs)"]) + """
SELECT c.l_orderkey, c.o_orderdate, CAST(0 AS INTEGER) AS o_shippriority,
  CAST(ROUND(sum(p.wrev), 4) AS DECIMAL(18,4)) AS revenue, CAST(sum(p.w) AS BIGINT) AS live,
  CAST(c.version AS INTEGER) AS version
FROM changed c JOIN pairs p ON p.l_orderkey = c.l_orderkey AND p.o_orderdate = c.o_orderdate
  AND p.version <= c.version
GROUP BY c.l_orderkey, c.o_orderdate, c.version""")
