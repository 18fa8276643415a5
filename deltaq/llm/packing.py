"""Bounded-space online packing of token ids into sequences of a fixed length.

Each task keeps a fixed number of open windows.  A piece goes into the open window it fits best
(least room left over).  When it fits none, the fullest window is emitted: if more than one per
cent of it is free, the head of the piece fills it to the brim first and the rest of the piece is
placed anew.  Texts longer than a window give whole windows first.  What is open when a task's
input ends is handed on, and leftovers of a fixed number of tasks at a time are packed together in
further rounds, until one small set remains; its windows are filled to the brim one after another,
so the whole table has one partly filled sequence.  No round holds more than a fixed number of
windows per task, whatever the input.

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

from deltaq.llm.common import batches, hand_back, materialize
from deltaq.llm.encode import encoder, tokenizer_path

WINDOW = 4096       # tokens in a sequence
OPEN = 16           # open windows per task
FAN_IN = 16         # tasks whose leftovers one task of the next round packs
SLACK = 0.01        # a window with at most this share free is emitted as it is

TYPES = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
         "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(),
         "left_of": pa.int64(), "ids": pa.binary()}
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, left_of long, ids binary")


class Packer:
    """Open windows of one task.  Pieces are (doc_id, start, doc_tokens, ids)."""

    def __init__(self, first_id: int, window: int = WINDOW, most: int = OPEN,
                 slack: float = SLACK) -> None:
        self.next_id, self.window, self.most = first_id, window, most
        self.slack = int(window * slack)
        self.free: list[tuple[int, int]] = []          # (room, window number), ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.number = 0

    def add(self, piece: tuple) -> Iterator[tuple]:
        """Place one piece; yields the rows of windows that are emitted."""
        doc_id, start, total, ids = piece
        while len(ids) >= self.window:
            yield from self._rows([(doc_id, start, total, ids[:self.window])])
            start, ids = start + self.window, ids[self.window:]
        if len(ids):
            yield from self._place((doc_id, start, total, ids))

    def _place(self, piece: tuple) -> Iterator[tuple]:
        while True:
            doc_id, start, total, ids = piece
            at = bisect_left(self.free, (len(ids), -1))
            if at < len(self.free):                    # the least room that is enough
                room, number = self.free.pop(at)
                self._put(number, room, piece)
                if room == len(ids):
                    yield from self._rows(self.pieces.pop(number))
                return
            if len(self.free) < self.most:
                self.number += 1
                self.pieces[self.number] = []
                self._put(self.number, self.window, piece)
                return
            room, number = self.free.pop(0)            # the fullest
            if room > self.slack:
                self.pieces[number].append((doc_id, start, total, ids[:room]))
                piece = (doc_id, start + room, total, ids[room:])
            yield from self._rows(self.pieces.pop(number))

    def _put(self, number: int, room: int, piece: tuple) -> None:
        self.pieces[number].append((*piece[:3], piece[3].copy()))
        if room > len(piece[3]):
            insort(self.free, (room - len(piece[3]), number))

    def _rows(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, total, ids in pieces:
            crc = zlib.crc32(ids.astype("<u4", copy=False).tobytes())
            yield doc_id, start, len(ids), crc, total, self.next_id, offset, None, None
            offset += len(ids)
        self.next_id += 1

    def leftovers(self, task: int) -> Iterator[tuple]:
        """Rows with the ids of what is still open, for the next round."""
        for pieces in self.pieces.values():
            for doc_id, start, total, ids in pieces:
                yield (doc_id, start, len(ids), None, total, None, None, task,
                       ids.astype("<u4", copy=False).tobytes())

    def finish(self) -> Iterator[tuple]:
        """Emit all that is open, filling each window before the next one begins."""
        left = [p for pieces in self.pieces.values() for p in pieces]
        self.pieces, self.free = {}, []
        current: list[tuple] = []
        room = self.window
        for doc_id, start, total, ids in sorted(left, key=lambda p: -len(p[3])):
            while len(ids):
                current.append((doc_id, start, total, ids[:room]))
                taken = len(current[-1][3])
                start, ids, room = start + taken, ids[taken:], room - taken
                if room == 0:
                    yield from self._rows(current)
                    current, room = [], self.window
        if current:
            yield from self._rows(current)


def _first_id(round_: int, task: int) -> int:
    return ((round_ << 24) + task) << 32


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 2,
         window: int = WINDOW, most_open: int = OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    file = tokenizer or tokenizer_path()

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer = Packer(_first_id(0, task), window, most_open)

        def rows() -> Iterator[tuple]:
            for part in parts:
                found = encoder(file).ids(t.as_py() for t in part.column(1))
                for doc_id, ids in zip(part.column(0).to_pylist(), found):
                    if end_id is not None:
                        ids = np.append(ids, np.uint32(end_id))
                    yield from packer.add((doc_id, 0, len(ids), ids))
            yield from packer.leftovers(task)

        yield from batches(TYPES, rows())
        hand_back()

    packed = materialize(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(first, SCHEMA), "packed")
    done = packed.filter("sequence_id is not null")
    left = packed.filter("sequence_id is null")
    tasks = (left.agg(F.max("left_of")).first()[0] or 0) + 1
    round_ = 0
    while True:
        round_ += 1
        last = tasks <= FAN_IN
        again = materialize(_merge(left, round_, last, window, most_open), "packed-left")
        done = done.unionByName(again.filter("sequence_id is not null"))
        if last:
            return done.drop("left_of", "ids")
        left = again.filter("sequence_id is null")
        tasks = -(-tasks // FAN_IN)


def _merge(left: DataFrame, round_: int, last: bool, window: int, most_open: int) -> DataFrame:
    """Pack the leftovers of FAN_IN tasks together: a fixed number of windows' worth per task."""

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            group, packer = None, None
            for part in parts:
                columns = [part.column(c).to_pylist() for c in
                           ("_group", "doc_id", "start", "doc_tokens", "ids")]
                for g, doc_id, start, total, ids in zip(*columns):
                    if g != group:
                        if packer is not None:
                            yield from packer.finish() if last else packer.leftovers(group)
                        group, packer = g, Packer(_first_id(round_, g), window, most_open)
                    yield from packer.add((doc_id, start, total, np.frombuffer(ids, "<u4")))
            if packer is not None:
                yield from packer.finish() if last else packer.leftovers(group)

        yield from batches(TYPES, rows())

    grouped = left.withColumn("_group", F.floor(F.col("left_of") / FAN_IN))
    return (grouped.repartition("_group")
            .sortWithinPartitions("_group", F.desc("length"), "left_of", "doc_id", "start")
            .mapInArrow(merge, SCHEMA))


def op10_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
