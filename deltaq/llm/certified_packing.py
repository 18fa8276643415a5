"""Packing whole documents into as few sequences as can be, with bounds that certify the counts.

Texts longer than a sequence are cut into whole sequences and a rest; rests and shorter texts are
packed whole.  Each task packs its pieces by best-fit decreasing, a fixed number of pieces (a
*partition*) at a time.  Dual feasible functions give lower bounds on the number of sequences any
packing of the same lengths needs: where the bound meets the count, the partition is certified and
no packing of it is better.  Of a certified partition only the emptiest sequence is given up; of
one with a gap, all but the fullest sequences, as many as are certified by themselves.  The pieces
given up are dealt anew, so partitions with gaps exchange documents, and best-fit decreasing runs
again over the new partitions.  Rounds go on while pieces are given up and the exchange still saves
sequences; the last round, or a round that fits one partition, keeps what it packs.

Bounds are taken over all lengths at once from a histogram (lengths are at most a sequence), so a
certificate costs the same whatever the partition holds.  ``lower_bound`` on the whole histogram
tells how far the whole packing can be from the best (``certificate``).

A task holds the lengths of one partition at a time; ids are encoded, their checksums taken and let
go.  What is exchanged are rows of a few numbers, a few a partition where certificates hold.

Edge cases: a null or empty text is the end id alone; repeated rows are packed each; null doc_ids
are kept as null; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import batches, materialize
from deltaq.llm.encode import encoder, tokenizer_path
from deltaq.llm.graph import runs

WINDOW = 4096           # tokens in a sequence
PARTITION = 1 << 16     # pieces packed together
ROUNDS = 6              # exchanges at most; what is then left is kept as packed
STAIRS = 64             # members of each family of dual feasible functions

TYPES = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
         "ids_crc32": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(),
         "kept": pa.bool_()}
SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
          "offset long, kept boolean")
_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]


def lower_bound(counts: np.ndarray, window: int = WINDOW) -> int:
    """Sequences that any packing needs of ``counts[x]`` pieces of length x (0 <= x <= window).

    The largest of: the volume; per threshold k, pieces over window - k as whole sequences and those
    under k as nothing; and two families of staircase functions, which round pieces up to shares of
    a sequence.  All are dual feasible: lengths that fit one sequence never add up to more than one,
    so each sum is a bound.  Sums are exact integers."""
    counts = np.asarray(counts, np.int64)
    lengths = np.arange(window + 1, dtype=np.int64)
    total = int((counts * lengths).sum())
    if not total:
        return int(counts[0] > 0)
    best = -(-total // window)
    # Thresholds: numbers of pieces and their lengths up to x.
    many, volume = np.cumsum(counts), np.cumsum(counts * lengths)
    k = np.arange(1, window // 2 + 1)
    large = many[window] - many[window - k]
    best = max(best, int(-(-(large * window + volume[window - k] - volume[k - 1]) // window).max()))
    some = np.flatnonzero(counts)
    x, c = lengths[some], counts[some]
    for n in range(1, STAIRS + 1):
        # (n + 1) x / window, rounded down, as shares of n; exact multiples stay what they are
        steps, exact = (n + 1) * x // window, (n + 1) * x % window == 0
        whole = int((c * np.where(exact, 0, steps)).sum())
        plain = int((c * np.where(exact, x, 0)).sum())
        best = max(best, -(-(whole * window + plain * n) // (n * window)))
    for e in {max(1, window * n // (2 * STAIRS)) for n in range(1, STAIRS + 1)}:
        shares = window // e
        big = shares - (window - x) // e
        value = np.where(2 * x > window, big, np.where(x >= e, 1, 0))
        best = max(best, -(-int((c * value).sum()) // shares))
    return best


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each piece, room left in each bin): longest first, each where least room is left."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []               # with an open bin, ascending
    left: list[int] = []
    where = [0] * len(lengths)
    for k, length in zip(range(len(lengths)), lengths[order].tolist()):
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            same = by_room[room]
            number = same.pop()
            if not same:
                del rooms[at]
        else:
            number, room = len(left), window
            left.append(window)
        where[k] = number
        room -= length
        left[number] = room
        if room:
            same = by_room.setdefault(room, [])
            if not same:
                insort(rooms, room)
            same.append(number)
    bins[order] = where
    return bins, np.array(left, np.int64)


def certified_bins(lengths: np.ndarray, bins: np.ndarray, left: np.ndarray, window: int = WINDOW,
                   ) -> tuple[np.ndarray, bool]:
    """Which bins are kept, and whether the partition is certified.  A certified partition keeps all
    but its emptiest bin; else the fullest bins are kept, as many as their own bound certifies."""
    n = len(left)
    keep = np.ones(n, bool)
    if lower_bound(np.bincount(lengths, minlength=window + 1), window) == n:
        if n and left.max() > 0:
            keep[int(left.argmax())] = False
        return keep, True
    order = np.argsort(left, kind="stable")      # fullest first
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    of_piece = rank[bins]

    def proven(m: int) -> bool:
        some = lengths[of_piece < m]
        return lower_bound(np.bincount(some, minlength=window + 1), window) == m

    low, high = 0, n - 1
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if proven(middle) else (low, middle - 1)
    keep[order[low:]] = False
    return keep, False


def _packed(rows: dict[str, np.ndarray], first_id: int, window: int, last: bool,
            ) -> Iterator[pa.RecordBatch]:
    """The pieces of one partition with their sequences; ``last`` keeps all of them."""
    lengths = rows["length"]
    bins, left = best_fit_decreasing(lengths, window)
    keep = np.ones(len(left), bool)
    if not last:
        keep, _ = certified_bins(lengths, bins, left, window)
    order = np.argsort(bins, kind="stable")
    sorted_bins, ends = bins[order], np.cumsum(lengths[order])
    begins = ends - lengths[order]
    offset = begins - begins[np.searchsorted(sorted_bins, sorted_bins)]
    for a in range(0, len(order), 8192):
        some = order[a:a + 8192]
        yield pa.RecordBatch.from_arrays(
            [rows[c].take(pa.array(some)) if isinstance(rows[c], pa.Array)
             else pa.array(rows[c][some], TYPES[c]) for c in _PIECE]
            + [pa.array(first_id + bins[some]), pa.array(offset[a:a + 8192]),
               pa.array(keep[bins[some]])], list(TYPES))


def _sequence_id(round_: int, task: int) -> int:
    """Sequences of a task count up from here: 2**30 a task, 2**24 tasks a round."""
    return (round_ << 54) + (task << 30)


def pack_whole(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 1,
               window: int = WINDOW, partition: int = PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    file = tokenizer or tokenizer_path()

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = _sequence_id(0, TaskContext.get().partitionId())
        held: list[tuple] = []
        whole: list[tuple] = []

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, held
            if held:
                rows = _columns(held)
                yield from _packed(rows, next_id, window, last=False)
                next_id += len(held)        # at most so many sequences
                held = []

        for part in parts:
            ids_of = encoder(file).ids(part.column(1).to_pylist())
            for doc_id, ids in zip(part.column(0).to_pylist(), ids_of):
                if end_id is not None:
                    ids = np.append(ids, np.uint32(end_id))
                ids = ids.astype("<u4", copy=False)
                for piece, start in enumerate(range(0, len(ids), window)):
                    some = ids[start:start + window]
                    row = (doc_id, piece, start, len(some), zlib.crc32(some.tobytes()))
                    if len(some) == window:
                        whole.append((*row, next_id, 0, True))
                        next_id += 1
                    else:
                        held.append(row)
                        if len(held) >= partition:
                            yield from emit()
                if len(whole) >= 8192:
                    yield from batches(TYPES, whole)
                    whole = []
        yield from batches(TYPES, whole)
        yield from emit()

    packed = materialize(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(first, SCHEMA), "whole-packed")
    done, out = packed.filter("kept"), packed.filter("not kept")
    before = None
    for round_ in range(1, rounds + 1):
        size = out.agg(F.count("*").alias("pieces"),
                       F.countDistinct("sequence_id").alias("sequences")).first()
        groups = -(-size.pieces // partition)
        # An exchange that saved nothing is the last: what it packed is kept.
        stuck = before is not None and size.pieces >= before
        last = round_ == rounds or groups <= 1 or stuck
        if size.pieces == 0:
            break
        before = size.pieces
        again = materialize(_repacked(out, groups, round_, window, last), "whole-repacked")
        done = done.unionByName(again.filter("kept"))
        out = again.filter("not kept")
        if last:
            break
    return done.drop("kept")


def _columns(held: list[tuple]) -> dict:
    doc_id, piece, start, length, crc = zip(*held)
    return {"doc_id": pa.array(doc_id, pa.int64()), "piece": np.array(piece), "start":
            np.array(start), "length": np.array(length, np.int64), "ids_crc32": np.array(crc)}


def _repacked(out: DataFrame, groups: int, round_: int, window: int, last: bool) -> DataFrame:
    """Deal the pieces given up over ``groups`` new partitions and pack each anew.  Pieces are dealt
    one by one, whatever sequence or document they come from, so each new partition mixes them."""

    def again(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(parts, ["_group"]):
            group = rows.column("_group")[0].as_py()
            columns: dict = {c: rows.column(c).to_numpy() for c in _PIECE[1:]}
            columns["doc_id"] = rows.column("doc_id").combine_chunks()
            yield from _packed(columns, _sequence_id(round_, group), window, last)

    dealt = out.select(*_PIECE, F.pmod(F.xxhash64("sequence_id", "offset", F.lit(round_)),
                                       F.lit(groups)).cast("long").alias("_group"))
    return (dealt.repartition("_group").sortWithinPartitions(
        "_group", F.desc("length"), "doc_id", "start", "ids_crc32").mapInArrow(again, SCHEMA))


def certificate(pieces: DataFrame, window: int = WINDOW) -> dict[str, int]:
    """How many sequences hold the pieces, and how many any packing needs: ``sequences``, ``bound``.
    The histogram of lengths has at most ``window`` rows, whatever the table."""
    counts = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    sequences = pieces.agg(F.countDistinct("sequence_id")).first()[0]
    return {"sequences": sequences, "bound": lower_bound(counts, window)}


def op13_certified_packing(docs: DataFrame) -> DataFrame:
    return pack_whole(docs)
