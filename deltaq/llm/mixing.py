"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

A source's target divided by its size is the expected number of copies of each of its documents.
The whole part is certain: every document gets that many copies.  What is left is the inclusion
probability p of one more copy, and a fixed number of words per source is drawn for it without
replacement: each document gets a uniform number u from a keyed digest of its id and text, and is
ranked by (u / (1 - u)) / (p / (1 - p)), random odds over inclusion odds.  The lowest ranks are
taken until the source's words are reached; the document that crosses the line is taken when that
comes nearer.  The words then still missing, or too many, are made up by the one document whose
size comes nearest to them, where that helps.  ``pareto_cut`` takes any expected copies per row, so probabilities may differ from
row to row.

No source is sorted in one task: ranks, mapped to (0, 1), are counted in ``BINS`` bins per source,
and only the bin in which the target is reached is sorted.  The cut is then a rank, so taking the
documents is a filter of each row on its own.

Edge cases: null texts have size 0 and are never repeated into words; null sources are one source,
last in order; null ids are ordinary; repeated rows are ranked alike, and as many of them are
taken as fit; an empty table gives an empty mix; sources without words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deltaq.llm.common import WORD, materialize

BINS = 4096
MOST_COPIES = 3
SEED = "mix-1"
#: Sources up to this many are joined by broadcast (about 200 bytes each), more by a shuffle.
BROADCAST_SOURCES = 20_000


def size_of(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)),
                      F.lit(0)).cast("long")


def digest_of(text: str | Column = "text") -> Column:
    return F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def uniform(doc_id: Column, digest: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) fixed by seed, id and text: 48 bits of a digest."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), digest)
    return (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> target words.  Weights 1, 2, 3, 1, ... by code point of the name,
    null last; the targets share all words, none above ``most`` times its source's size, the
    excess going to the others by weight.  Sources in order of limit over weight reach their
    limit first, so running sums tell which do.  One row per source is handled in one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.select(
        "source", "source_size", (F.col("source_size") * float(most)).alias("_cap"),
        (1 + (F.row_number().over(by_name) - 1) % 3).cast("double").alias("weight"))
    filling = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0.0))
    weights = F.sum("weight").over(filling.rowsBetween(Window.currentRow,
                                                       Window.unboundedFollowing))
    total = F.sum("source_size").over(every).cast("double")
    s = s.withColumn("_full", F.col("_cap") / F.col("weight") <= (total - before) / weights)
    level = ((total - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(every))
             / F.sum(F.when(~F.col("_full"), F.col("weight"))).over(every))
    return s.select("source", "source_size", "weight", F.when(
        F.col("_full"), F.col("_cap")).otherwise(F.col("weight") * level).alias("target"))


def _rank(u: Column, p: Column) -> Column:
    """Pareto rank q / (1 + q), in (0, 1): random odds over inclusion odds; null where p is 0."""
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, q / (1 + q))


def _order(rank: Column, doc_id: Column, digest: Column) -> Column:
    """Total order of rows: rank, then id (null last), then text."""
    return F.struct(rank.alias("rank"), doc_id.isNull().alias("no_id"),
                    F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"),
                    digest.alias("digest"))


def pareto_cut(rows: DataFrame) -> DataFrame:
    """Where each source's order is cut.  ``rows``: source, size, expected, order_key (of
    ``_order``).  Returns (source, cut, ties): rows below ``cut`` are taken, and ``ties`` of those
    equal to it."""
    part = F.col("expected") - F.floor("expected")
    r = rows.filter(part > 0).select(
        "source", "size", "order_key",
        F.floor(F.col("order_key.rank") * BINS).cast("int").alias("_bin"))
    need = rows.groupBy("source").agg(F.sum(part * F.col("size")).alias("need"))
    bins = r.groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    running = Window.partitionBy("source").orderBy("_bin")
    before = F.sum("_words").over(running) - F.col("_words")
    # At most BINS rows per source.
    bins = (bins.select("source", "_bin", "_words", before.alias("_before"))
            .join(need.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
            .filter((F.col("_before") < F.col("need")) | (F.col("_before") == 0))
            .withColumn("_last", F.row_number().over(
                Window.partitionBy("source").orderBy(F.desc("_bin"))) == 1)
            .filter("_last").select("_s", F.col("_bin").alias("_b"), "_before", "need"))
    inside = r.join(F.broadcast(bins), F.col("source").eqNullSafe(F.col("_s"))
                    & (F.col("_bin") == F.col("_b"))) if _few(bins) else r.join(
        bins, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    up_to = F.sum("size").over(Window.partitionBy("source").orderBy("order_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    taken = (inside.withColumn("_middle", F.col("_before") + up_to - F.col("size") / 2)
             .filter(F.col("_middle") <= F.col("need")))
    cuts = (taken.groupBy("source", "order_key").agg(F.count("*").alias("ties"))
            .groupBy("source").agg(F.max(F.struct("order_key", "ties")).alias("_m"))
            .select(F.col("source").alias("_s2"), "_m"))
    floor_key = _order(F.col("_b") / float(BINS), F.lit(-(1 << 63)).cast("long"), F.lit(""))
    return bins.join(cuts, F.col("_s").eqNullSafe(F.col("_s2")), "left").select(
        F.col("_s").alias("source"),
        F.coalesce(F.col("_m.order_key"), floor_key).alias("cut"),
        F.coalesce(F.col("_m.ties"), F.lit(0)).alias("ties"))


def _few(sources: DataFrame) -> bool:
    return len(sources.limit(BROADCAST_SOURCES + 1).select(F.lit(1)).take(
        BROADCAST_SOURCES + 1)) <= BROADCAST_SOURCES


def _join_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join one row per source, broadcast if they are few."""
    side = sources.withColumnRenamed("source", "_of")
    side = F.broadcast(side) if sources.count() <= BROADCAST_SOURCES else side
    return rows.join(side, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def mix_plan(light: DataFrame) -> DataFrame:
    """One row per source: source_size, target, expected copies, cut, ties and swap.
    ``light``: source, size, doc_id, digest of every document."""
    sources = source_targets(light.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = materialize(sources.withColumn("expected", F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)),
        "mix-sources")
    rows = _join_sources(light, sources.select("source", "expected"))
    rows = rows.select("source", "size", "expected", _row_order().alias("order_key"))
    cuts = pareto_cut(rows).withColumnRenamed("source", "_c")
    no_swap = rows.schema["order_key"].dataType.simpleString()
    plan = materialize(sources.join(cuts, F.col("source").eqNullSafe(F.col("_c")), "left").drop(
        "_c").withColumn("swap", F.lit(None).cast(no_swap)), "mix-cuts")
    # One document to make up the difference: taken as well, or not taken after all.
    marked = _marked(light, plan)
    gaps = marked.groupBy("source").agg((
        F.sum((F.col("expected") - F.floor("expected")) * F.col("size"))
        - F.sum(F.col("size") * F.col("_more"))).alias("_gap"))
    gaps = materialize(gaps, "mix-gaps")
    off = F.abs(F.col("size") - F.abs("_gap"))
    swaps = (_join_sources(marked, gaps).filter(
        (((F.col("_gap") > 0) & (F.col("_more") == 0)) | ((F.col("_gap") < 0)
                                                          & (F.col("_more") == 1)))
        & F.col("_key.rank").isNotNull() & (off < F.abs("_gap")))
        .groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("_key").alias("key"),
                                              F.signum("_gap").cast("int").alias("by")))
                               .alias("_w"))
        .select(F.col("source").alias("_c"), "_w.key", "_w.by"))
    at_cut = F.coalesce(F.col("key") == F.col("cut"), F.lit(False))
    return materialize(plan.drop("swap").join(
        swaps, F.col("source").eqNullSafe(F.col("_c")), "left").select(
        "source", "source_size", "target", "expected", "cut",
        (F.col("ties") + F.when(at_cut, F.col("by")).otherwise(0)).alias("ties"),
        F.when(~at_cut, F.col("key")).alias("swap")), "mix-plan")


def _row_order() -> Column:
    part = F.col("expected") - F.floor("expected")
    return _order(_rank(uniform(F.col("doc_id"), F.col("digest")), part), F.col("doc_id"),
                  F.col("digest"))


def _marked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan, ``_key`` and ``_more``: 1 where a further copy is taken."""
    r = _join_sources(rows, plan).withColumn("_key", _row_order())
    ranked = F.col("_key.rank").isNotNull() & F.col("cut").isNotNull()
    tied = ranked & ((F.col("_key") == F.col("cut"))
                     | F.coalesce(F.col("_key") == F.col("swap"), F.lit(False)))
    below = (ranked & (F.col("_key") < F.col("cut"))).cast("int")
    plain = r.filter(~F.coalesce(tied, F.lit(False))).withColumn(
        "_more", F.coalesce(below, F.lit(0)))
    # Rows at the cut or swapped: two per source, unless rows repeat with id and text.
    number = F.row_number().over(Window.partitionBy("source", "_key").orderBy("_key"))
    special = r.filter(F.coalesce(tied, F.lit(False))).withColumn("_rn", number).withColumn(
        "_more", F.when(F.col("_key") == F.col("cut"), (F.col("_rn") <= F.col("ties")).cast("int"))
        .when(F.col("_rn") == 1, 1 - below).otherwise(below)).drop("_rn")
    return plain.unionByName(special)


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add the plan's columns and ``copies`` to rows (source, size, doc_id, digest, ...)."""
    return _marked(rows, plan).withColumn(
        "copies", (F.floor("expected") + F.col("_more")).cast("long")).drop(
        "_key", "_more", "cut", "ties", "swap")


def _light(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       size_of().alias("size"), digest_of().alias("digest"))


def op7_mixing(docs: DataFrame) -> DataFrame:
    light = materialize(_light(docs), "mix-sizes")
    return with_copies(light, mix_plan(light)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("_row")).select(
        F.col("_row.doc_id").cast("long").alias("doc_id"),
        F.col("_row.source").cast("string").alias("source"),
        size_of(F.col("_row.text")).alias("size"),
        digest_of(F.col("_row.text")).alias("digest"), "_row")
    plan = mix_plan(materialize(rows.drop("_row"), "mix-sizes"))
    taken = with_copies(rows, plan).filter("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
                        ).select("_row.*")


# Windows here sort whole sources, which is fine for one machine's check.
OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * {MOST_COPIES}.0::DOUBLE AS cap,
        (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM s),
f AS (SELECT *, cap / weight <=
        ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN
            UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) /
        (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS is_full
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight *
        (((sum(source_size) OVER ())::DOUBLE
          - sum(CASE WHEN is_full THEN cap ELSE 0.0 END) OVER ())
         / (sum(CASE WHEN NOT is_full THEN weight END) OVER ())) END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS expected
      FROM t),
u AS (SELECT d.*, e.source_size, e.target, floor(expected) AS whole,
        expected - floor(expected) AS part,
        (('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || digest), 1, 12)
          )::BIGINT::DOUBLE + 0.5) / {float(1 << 48)!r} AS u
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
q AS (SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS q FROM u),
c AS (SELECT *, q / (1 + q) AS r, CASE WHEN q IS NOT NULL
          AND sum(CASE WHEN q IS NULL THEN 0 ELSE size END) OVER (
          PARTITION BY source ORDER BY q / (1 + q) NULLS LAST, doc_id NULLS LAST, digest
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2
        <= sum(part * size) OVER (PARTITION BY source) THEN 1 ELSE 0 END AS more FROM q),
g AS (SELECT *, sum(part * size) OVER (PARTITION BY source)
        - sum(size * more) OVER (PARTITION BY source) AS gap FROM c),
h AS (SELECT *, q IS NOT NULL AND abs(size - abs(gap)) < abs(gap)
        AND ((gap > 0 AND more = 0) OR (gap < 0 AND more = 1)) AS fits FROM g),
k AS (SELECT *, fits AND row_number() OVER (PARTITION BY source ORDER BY fits DESC,
        abs(size - abs(gap)), r, doc_id NULLS LAST, digest) = 1 AS swapped FROM h)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN swapped THEN 1 - more ELSE more END))::BIGINT AS taken FROM k
"""
