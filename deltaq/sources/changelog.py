"""Changelog text source and sink (A1, A5).

A changelog is a folder of text files of lines ``OP|table|fields``; the order of lines is the order
of changes.  The reader gives every line an integer ``seq`` (decimal(38,0)) made of

    the file's place (16 digits)  block start of the split (12)  row in the task (10)

A file's *place* follows all the numbers of its path below the folder, compared as numbers, and the
text between them (``part-99999`` before ``part-100000``, ``2026-12-03-001`` before
``2026-12-03-002``, ``log-2-9`` before ``log-2-10``).  The random id that Spark puts into the names
of part files says nothing about order and is left out.  Two files with the same place have no
order, so they are an error, never a guess.  Within a split the row number grows with the line, and
splits of one file are ordered by their start: one number, no global sort, no pass to count lines,
and its maximum is a hash aggregate.

The writer keeps the contract: it range-partitions by the change order, so part numbers follow it,
and every append goes to a folder of its own, ``batch=0``, ``batch=1``, ..., whose number leads.

A folder read at once has places 0, 1, 2, ... in that order, whatever the names look like (``NAME``).
A stream cannot know the names to come.  Two orders are offered there: ``ARRIVAL`` (the micro-batch
leads with 8 digits; within it, places 0, 1, 2, ... as above) and ``NAME``, where a late file takes
the place its numbers give it: each number gets a fixed width (``widths``, by default two of eight
digits; dated names need such as ``(4, 2, 2, 3)``; the writer's own names need nothing), and a name
with more or longer numbers, or with none, is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

NAME = "name"
ARRIVAL = "arrival"
SEQ_TYPE = "decimal(38,0)"
BATCH = "batch"
_ROW, _BLOCK, _FILE, _LEAD = 10, 12, 16, 8
#: Lines of a part file from which the writer makes more parts than the session has partitions, so
#: that a part is sorted in memory.
PART_LINES = 500_000
#: The writer's parts from a sample: cells that the order's values are counted in, and the sampled rows
#: a part that are needed.
CELLS, PART_SAMPLE = 1 << 14, 50
#: Digits of the numbers of a file's path in a stream in NAME order.
WIDTHS = (8, 8)
#: Files whose places are broadcast to the lines (about 100 bytes each); more are joined by shuffle.
BROADCAST_FILES = 200_000

_PART = re.compile(
    "(part-[0-9]+)-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")
#: What the writer makes: a folder of part files, with appended ones in folders of their batch.
_OWN = re.compile(f"(?:{BATCH}=([0-9]+)/)?{_PART.pattern}(?:-c([0-9]+))?[.a-z0-9]*".replace(
    "(part-[0-9]+)", "part-([0-9]+)"))
_OWN_WIDTHS = (5, 7, 4)
_SLASHES = "^([a-z0-9]+):///"
_PIECES = re.compile("([0-9]+)")


class OrderError(ValueError):
    """Files of a changelog whose order their names do not tell."""


def natural_key(path: str) -> tuple:
    """Texts and numbers of a path in turn, the numbers as numbers."""
    pieces = _PIECES.split(_PART.sub(r"\1", path))
    return tuple(int(x) if i % 2 else x for i, x in enumerate(pieces))


def natural_places(paths: Iterable[str]) -> dict[str, int]:
    """path -> 0, 1, 2, ... in natural order; files that tie are an error."""
    ordered = sorted((natural_key(p), p) for p in set(paths))
    for (key, path), (other, again) in zip(ordered, ordered[1:]):
        if key == other:
            raise OrderError(f"nothing in their names orders {path} and {again}")
    return {path: place for place, (_, path) in enumerate(ordered)}


def fixed_place(path: str, widths: Sequence[int] = WIDTHS) -> int:
    """One integer from the numbers of a path, each in its width; the same for any other files."""
    if sum(widths) > _FILE:
        raise ValueError(f"widths have {sum(widths)} digits, {_FILE} at most")
    own = _OWN.fullmatch(path)
    if own:
        batch, part, file = own.groups()
        numbers: Sequence[int] = (int(batch) + 1 if batch else 0, int(part), int(file or 0))
        widths = _OWN_WIDTHS
    else:
        numbers = natural_key(path)[1::2]
    if not numbers:
        raise OrderError(f"no number in the name of changelog file {path}")
    if len(numbers) > len(widths) or any(n >= 10 ** w for n, w in zip(numbers, widths)):
        raise OrderError(f"the numbers of {path} do not fit widths {tuple(widths)}")
    place = 0
    for i, w in enumerate(widths):      # a name with fewer numbers comes before its extensions
        place = place * 10 ** w + (numbers[i] if i < len(numbers) else 0)
    return place


def fixed_places(paths: Iterable[str], widths: Sequence[int] = WIDTHS) -> dict[str, int]:
    places = {p: fixed_place(p, widths) for p in set(paths)}
    seen: dict[int, str] = {}
    for path, place in sorted(places.items()):
        if place in seen:
            raise OrderError(f"nothing in their names orders {seen[place]} and {path}")
        seen[place] = path
    return places


def below(root: str, file: str) -> str:
    """A file's path below the folder of the changelog (both as Spark and Hadoop spell them)."""
    root, file = spelled(root.rstrip("/")), spelled(file)
    return file[len(root) + 1:] if file.startswith(root + "/") else file


def spelled(path: str) -> str:
    """A path in one spelling: listings write ``file:/x`` as well as ``file:///x``."""
    return re.sub(_SLASHES, r"\1:/", path)


def with_order(lines: DataFrame, places: dict[str, int], batch_id: int | None = None) -> DataFrame:
    """``(seq, value)`` of lines that carry ``_file`` and ``_block``; ``places`` by ``_file``.  The
    places are a few rows a file, one for each spelling of its path, so that no line's path needs to
    be spelled anew: broadcast while those are few, joined by shuffle beyond."""
    spark = lines.sparkSession
    rows = {path: p for f, p in places.items() for path in spellings(f)}
    table = spark.createDataFrame(list(rows.items()), "_file string, _place bigint").select(
        "_file", place_start(F.col("_place"), batch_id).alias("_start"))
    if len(places) <= BROADCAST_FILES:
        table = F.broadcast(table)
    # Lines are numbered before anything can move them.
    numbered = lines.withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    unknown = F.raise_error(F.concat(F.lit("no place for changelog file "), "_file"))
    return numbered.join(table, "_file", "left").select(
        line_seq(F.coalesce("_start", unknown.cast(SEQ_TYPE)), F.col("_block"), F.col("_row"))
        .alias("seq"), "value")


def spellings(path: str) -> set[str]:
    """The spellings of a path that a scan or a listing may give."""
    plain = spelled(path)
    return {path, plain, re.sub("^([a-z0-9]+):/(?!/)", r"\1:///", plain)}


def _shift(x: Column, digits: int, places: int) -> Column:
    return (x.cast(f"decimal({digits},0)")
            * F.lit(Decimal(10) ** places).cast(f"decimal({places + 1},0)"))


def place_start(place: Column, batch_id: int | None = None) -> Column:
    """``seq`` before the first line of a file; a micro-batch's number leads where one is given."""
    digits = _FILE if batch_id is None else _FILE - _LEAD
    start = _shift(place, digits, _BLOCK + _ROW).cast(SEQ_TYPE)
    if batch_id is not None:
        lead = Decimal(batch_id) * Decimal(10) ** (_FILE - _LEAD + _BLOCK + _ROW)
        start = start.cast("decimal(31,0)") + F.lit(lead).cast(SEQ_TYPE)
    return start.cast(SEQ_TYPE)


def line_seq(start: Column, block: Column, row: Column) -> Column:
    """``seq`` of a line after its file's start: one decimal addition a line where the block's start
    leaves room for the row in 64 bits."""
    digits = f"decimal({_BLOCK + _ROW + 1},0)"
    near = (block * F.lit(10 ** _ROW) + row).cast(digits)
    far = (_shift(block, _BLOCK, _ROW) + row.cast(f"decimal({_ROW},0)")).cast(digits)
    return (start + F.when(block < F.lit(10 ** (18 - _ROW)), near).otherwise(far)).cast(SEQ_TYPE)


def line_order(place: Column, block: Column, row: Column, batch_id: int | None = None) -> Column:
    """``seq`` of a line as one integer."""
    return line_seq(place_start(place, batch_id), block, row)


def source_columns(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_block"))


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """A1 (batch): ``(seq, value)`` for every line.  The names are those of Spark's own listing,
    which the driver holds; no line is read for them."""
    lines = spark.read.text(path)
    root = storage.qualified(spark, path)
    files = {f: below(root, f) for f in lines.inputFiles()}
    places = natural_places(files.values())
    return with_order(source_columns(lines), {f: places[n] for f, n in files.items()})


def batch_order(batch: DataFrame, root: str, batch_id: int, order: str = NAME,
                widths: Sequence[int] = WIDTHS) -> tuple[DataFrame, dict[str, int]]:
    """A1 (stream): ``(seq, value)`` of one micro-batch of ``source_columns``, and the places of its
    files by their path below ``root``.  The files of a micro-batch are those the stream's log
    names, as many as the driver handed out; one pass over the batch tells them."""
    files = {r["_file"]: below(root, r["_file"])
             for r in batch.select("_file").distinct().collect()}
    if order == ARRIVAL:
        places = natural_places(files.values())
    else:
        places = fixed_places(files.values(), widths)
    lines = with_order(batch, {f: places[n] for f, n in files.items()},
                       batch_id if order == ARRIVAL else None)
    return lines, places


def read_changelog_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 1,
                          bytes_per_trigger: str | None = None) -> DataFrame:
    """A1 (stream): text lines as they arrive; files are taken oldest first.  Bound a micro-batch
    by ``bytes_per_trigger`` (such as "200g") on a cluster, where files are many."""
    reader = spark.readStream.format("text")
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    elif files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _part_of(order: str, sample: DataFrame, n: int) -> Column | None:
    """The part (of ``n``, in order and about as large as each other) of a row, by counts of a sample's
    values in cells of equal width; none where the sample is small or a cell would fill parts."""
    low, high = sample.agg(F.min(order).cast("double"), F.max(order).cast("double")).first()
    if low is None or low >= high:
        return None
    cell = F.width_bucket(F.col(order).cast("double"), F.lit(low), F.lit(high), F.lit(CELLS))
    counts = {r["c"]: r["n"] for r in sample.filter(F.col(order).isNotNull()).groupBy(
        cell.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if total < n * PART_SAMPLE or max(counts.values()) * n > 2 * total:
        return None
    parts, before = [], 0
    for c in range(CELLS + 2):
        parts.append(str(before * n // total))
        before += counts.get(c, 0)
    parts[-1] = str(n - 1)
    known = F.split(F.lit(",".join(parts)), ",").cast("array<int>")
    return F.coalesce(F.element_at(known, (cell + 1).cast("int")), F.lit(0))


def write_changelog(changes: DataFrame, path: str, order: str = "seq", line: str = "line",
                    partitions: int | None = None, mode: str = "overwrite",
                    sample: DataFrame | None = None) -> None:
    """A5: write ``line`` in ``order`` as gzipped text; part numbers follow the change order, and
    each append goes to the folder of the next batch number, so it comes after all before it.  The
    parts follow the number of lines, unless ``partitions`` gives them.  A ``sample`` of the changes,
    where making them costs more than reading their tables, spares a pass over them all to find where
    parts begin."""
    spark = changes.sparkSession
    n = int(partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              -(-changes.count() // PART_LINES)))
    if mode == "append":
        done = [int(x[len(BATCH) + 1:]) for x in storage.children(spark, path)
                if x.startswith(f"{BATCH}=")]
        path, mode = f"{path.rstrip('/')}/{BATCH}={max(done, default=-1) + 1}", "overwrite"
    part = None if sample is None else _part_of(order, sample, n)
    dealt = (changes.repartitionByRange(n, F.col(order)) if part is None
             else changes.repartitionById(n, part))
    (dealt.sortWithinPartitions(order).select(F.col(line).alias("value")).write.mode(mode)
     .option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip"))
