"""Build hand-made changelogs in the reference layout and evaluate them three ways."""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import functions as F

from deltaq.operators import parse as P
from deltaq.operators import replay as R
from deltaq.plans.incremental import live_groups, q3_from_signed
from deltaq.plans.q3 import q3
from deltaq.schemas import REFERENCE
from deltaq.streaming.normalise import normalise


def cust(op, key, seg="AUTOMOBILE"):
    return f"{op}|customer|{key}|Customer#{key}|addr|1|11-111|10.00|{seg}|c"


def order(op, key, cust_key, date="1995-01-01", prio=0):
    return f"{op}|orders|{key}|{cust_key}|O|100.00|{date}|1-URGENT|Clerk#1|{prio}|o"


def item(op, okey, line, price="100.00", disc="0.10", ship="1995-06-01"):
    return (f"{op}|lineitem|{okey}|1|1|{line}|1.00|{price}|{disc}|0.00|N|O|{ship}|{ship}|{ship}"
            f"|DELIVER|MAIL|i")


def lines_df(spark, lines):
    rows = [(i, v) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "seq bigint, value string")


def routes(spark, lines):
    parsed = P.parse(lines_df(spark, lines), REFERENCE)
    return P.route_all(parsed, REFERENCE)


def batch_result(spark, lines):
    """Replay (C1-C3) then the flagship query."""
    r = routes(spark, lines)
    live = {t: R.live(df, REFERENCE[t].key) for t, df in r.items()}
    return as_set(q3(live["customer"], live["orders"], live["lineitem"]))


def normalised_result(spark, lines, cuts, scratch, every=8):
    """Split the changelog at ``cuts`` into micro-batches, normalise each, sum the weights."""
    r = routes(spark, lines)
    bounds = [0, *cuts, len(lines)]
    signed = {}
    for t, df in r.items():
        batch_of = F.lit(None).cast("int")
        for b in range(len(bounds) - 1):
            batch_of = F.when((F.col("seq") >= bounds[b]) & (F.col("seq") < bounds[b + 1]),
                              F.lit(b)).otherwise(batch_of)
        changes = df.withColumn("b", batch_of)

        def read(batches, changes=changes):
            return changes.filter(F.col("b").isin(batches))
        for b in range(len(bounds) - 1):
            out = normalise(spark, read, b, os.path.join(scratch, "log", t), REFERENCE[t].key,
                            every=every)
            path = os.path.join(scratch, "signed", t, f"b={b}")
            out.write.mode("overwrite").parquet(path)
        signed[t] = spark.read.parquet(os.path.join(scratch, "signed", t))
    return as_set(live_groups(q3_from_signed(signed)))


def as_set(df):
    return {(r.l_orderkey, r.o_orderdate.isoformat(), r.o_shippriority, str(r.revenue))
            for r in df.collect()}


def python_replay(lines):
    """Sequential replay in plain Python over the reference layout (the test oracle)."""
    tables = {"customer": [], "orders": [], "lineitem": []}
    keys = {"customer": (0,), "orders": (0,), "lineitem": (0, 3)}
    for line in lines:
        p = line.strip().split("|")
        op, t, f = p[0].upper(), p[1].lower(), p[2:]
        k = tuple(f[i] for i in keys[t])
        if op == "INSERT":
            tables[t].append(f)
        else:
            tables[t] = [row for row in tables[t] if tuple(row[i] for i in keys[t]) != k]
    groups = {}
    for li in tables["lineitem"]:
        if li[10] <= "1995-03-13":
            continue
        for o in tables["orders"]:
            if o[0] != li[0] or o[4] >= "1995-03-13":
                continue
            for c in tables["customer"]:
                if c[0] == o[1] and c[6] == "AUTOMOBILE":
                    g = (int(li[0]), o[4], int(o[7]))
                    groups[g] = groups.get(g, Decimal(0)) + Decimal(li[5]) * (1 - Decimal(li[6]))
    return {(k[0], k[1], k[2], str(v.quantize(Decimal("0.0001")))) for k, v in groups.items()}

