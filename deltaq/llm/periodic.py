"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A *run* is a stretch of consecutive words with smallest period q (words q apart are identical), at
least ``max(least, times * q)`` words long, that no neighbouring word extends.  ``SquareCatcher``
takes words in the order they are appended.  Each completed block of 8, 16, 32, ... words is a
catcher for the periods from its own length to less than twice that (blocks of 8 also for the
shorter periods): when the block comes again q words later, the words around it may be a square.
Each appended word advances one comparison per block length: the fingerprint of the suffix of that
length against the catcher whose periods it falls in.  A caught square that lies in a run already
known merges with it; any other is compared word by word to both sides.  What still reaches the
last word stays open and goes on with the next words appended.

A run of period q holds 2q words (and at least ``least - q``) that are equal to the words q later,
so whichever way the blocks lie, one whole block of the right length is among them: nothing is
missed.  Fingerprints only nominate; words are compared before anything is reported, so collisions
cost time, never results.  Memory follows the words of the text and a few fingerprints a block
length; the work is a constant number of array operations per word and block length.

Texts are dealt over tasks as they are read; nothing is shuffled.  Short texts share one catcher,
with a word of its own between any two, across which no square can reach.

Edge cases: a null or empty text has no words, no runs and an empty collapsed text; a null doc_id is
kept; repeated rows are handled each; an empty table gives an empty one; other columns are ignored.
One text is handled by one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 24          # words of a run at least
TIMES = 3           # periods of a run at least
SLAB = 1 << 16      # words appended at once
GROUP_WORDS = 1 << 18   # words of short texts that share a catcher
LONG_TEXT = 1 << 12     # words from which a text has a catcher of its own

#: Multipliers of the fingerprints (odd, otherwise arbitrary).
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: (doc_id, words) -> the words' numbers in a new order, or None for the words as they are.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * _LEFT
    out ^= right * _RIGHT + (out >> np.uint64(29))
    out *= _RIGHT
    out ^= out >> np.uint64(32)
    return out


def _first_false(same: np.ndarray) -> int:
    at = int(same.argmin()) if len(same) else 0
    return len(same) if at >= len(same) or same[at] else at


class SquareCatcher:
    """Runs of a growing sequence of words, each an integer.  ``longest`` may bound the length of
    any run; blocks too long for it are left out."""

    def __init__(self, least: int = LEAST, times: int = TIMES, longest: int | None = None) -> None:
        if times < 3:
            raise ValueError("runs of at least three periods are caught")
        self.least, self.times, self.longest = least, times, longest
        #: the shortest block: still whole inside a run's words that come again, whatever the grid
        self.block = 1
        while self.block < 8 and all(
                2 * (2 * self.block) - 1 <= max(least, times * q) - q
                for q in range(1, 4 * self.block)):
            self.block *= 2
        self.words = np.zeros(1024, np.int64)
        self.n = 0
        self.names: list[tuple[int, np.ndarray]] = []   # per block length: first start, fingerprints
        self.open: list[tuple[int, int]] = []           # (start, period) that reach the last word
        self.found: list[tuple[int, int, int]] = []     # (start, end, period), closed

    def append(self, words: np.ndarray) -> None:
        for a in range(0, len(words), SLAB):
            self._append(words[a:a + SLAB])

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, end, period) of every run of what was appended, by start, then period."""
        still = [(s, self.n, q) for s, q in self.open]
        periods: dict[tuple[int, int], int] = {}
        # A stretch that colliding fingerprints had compared for a multiple of its period as well:
        for s, e, q in sorted(self.found + [r for r in still if self._long_enough(*r)]):
            periods.setdefault((s, e), q)
        return sorted((s, e, q) for (s, e), q in periods.items())

    def _long_enough(self, start: int, end: int, period: int) -> bool:
        return end - start >= max(self.least, self.times * period)

    def _may_hold(self, length: int) -> bool:
        """Whether a run can be long enough for the periods that blocks of this length catch."""
        return self.longest is None or self.longest >= max(
            self.least, self.times * (length if length > self.block else 1))

    def _append(self, words: np.ndarray) -> None:
        n0, n1 = self.n, self.n + len(words)
        while n1 > len(self.words):
            self.words = np.concatenate([self.words, np.zeros_like(self.words)])
        self.words[n0:n1] = words
        self.n = n1
        known = [(s, self._end(n0, q), q) for s, q in self.open]
        length, level = 1, 0
        while length <= n1 and self._may_hold(length):
            self._name(level, n0, n1)
            if length == self.block:
                low = 1
                while low < 2 * length:
                    known += self._catch(level, low, min(2 * low, 2 * length), n0, n1, known)
                    low *= 2
            elif length > self.block:
                known += self._catch(level, length, 2 * length, n0, n1, known)
            length, level = 2 * length, level + 1
        self.open = [(s, q) for s, e, q in known if e == n1]
        self.found += [r for r in known if r[1] < n1 and self._long_enough(*r)]
        for k, (first, names) in enumerate(self.names):
            keep = max(0, n1 - (3 << k) - first)
            self.names[k] = (first + keep, names[keep:].copy())

    def _name(self, level: int, n0: int, n1: int) -> None:
        """Fingerprints of the windows of 2**level words that end in the words just appended."""
        length = 1 << level
        if level == 0:
            new = self.words[n0:n1].astype(np.uint64)
            start = n0
        else:
            start = max(0, n0 - length + 1)
            first, half = self.names[level - 1]
            a, b = start - first, n1 - length + 1 - first
            new = _mixed(half[a:b], half[a + length // 2:b + length // 2])
        if level == len(self.names):
            self.names.append((start, new))
        else:
            first, names = self.names[level]
            self.names[level] = (first, np.concatenate([names[:start - first], new]))

    def _catch(self, level: int, low: int, high: int, n0: int, n1: int,
               known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Squares of periods low <= q < high that the appended words complete at the catchers of
        2**level words, as (start, end, period), without those in a run already known."""
        length = 1 << level
        first, names = self.names[level]
        newest = max(0, n0 - length + 1)
        a = max(-(-first // length), newest // length - 1) * length   # the first catcher
        rows = -(-(n1 - length + 1 - a) // length)
        if rows < 1:
            return []
        grid = np.zeros(rows * length, np.uint64)
        grid[:n1 - length + 1 - a] = names[a - first:]
        grid = grid.reshape(rows, length)
        if low < length:        # the block comes again before the next one begins
            row, column = np.nonzero(grid[:, low:high] == grid[:, :1])
            column += low
        else:
            row, column = np.nonzero(grid[1:] == grid[:-1, :1])
            column += length
        if not len(row):
            return []
        block, period = a + row * length, column
        again = block + period
        keep = (again >= newest) & (again + length <= n1)
        block, period = block[keep], period[keep]
        keep = np.ones(len(block), bool)                # in order of block
        for s, e, q in known:
            if e - s > length:
                x, y = np.searchsorted(block, [s, e - length])
                keep[x:y] &= (period[x:y] % q != 0) | (block[x:y] + period[x:y] + length > e)
        block, period = block[keep], period[keep]
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        chains = np.flatnonzero(np.diff(block, prepend=-length - 1) - length
                                | np.diff(period, prepend=-1))
        ends = np.append(chains[1:], len(block)) - 1
        out: list[tuple[int, int, int]] = []
        for c, d in zip(chains.tolist(), ends.tolist()):
            out += self._squares(int(block[c]), int(block[d]) + length, int(period[c]), n1)
        return out

    def _squares(self, a: int, b: int, period: int, n1: int) -> list[tuple[int, int, int]]:
        """Stretches around words a..b, each said to come again ``period`` words later, that are
        long enough or may still become so."""
        x, out = self.words, []
        same = x[a:b] == x[a + period:b + period]
        parts = [(a, b)]
        if not same.all():      # fingerprints collided
            edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            parts = [(a + int(i), a + int(j)) for i, j in zip(edges[::2], edges[1::2])]
        for low, high in parts:
            start, end = self._start(low, period), self._end(high + period, period)
            if end == n1 or self._long_enough(start, end, period):
                out.append((start, end, period))
        return out

    def _start(self, at: int, period: int) -> int:
        """The first of the words up to ``at`` that all come again a period later."""
        step = 16
        while at > 0:
            low = max(0, at - step)
            same = (self.words[low:at] == self.words[low + period:at + period])[::-1]
            back = _first_false(same)
            at -= back
            if back < len(same):
                break
            step *= 2
        return at

    def _end(self, at: int, period: int) -> int:
        """Where the words from ``at`` on stop to be those a period before."""
        step = 16
        while at < self.n:
            high = min(self.n, at + step)
            same = self.words[at:high] == self.words[at - period:high - period]
            on = _first_false(same)
            at += on
            if on < len(same):
                break
            step *= 2
        return at


class _Numbers(dict):
    """word -> number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def runs_of_texts(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES,
                  ) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each of a few texts of numbered words."""
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    catcher = SquareCatcher(least, times, max((len(t) for t in texts), default=0))
    stream = np.empty(int(starts[-1]), np.int64)
    for k, (a, t) in enumerate(zip(starts.tolist(), texts)):
        stream[a:a + len(t)] = t
        stream[a + len(t)] = -1 - k         # between texts: a word that never comes again
    catcher.append(stream)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, q in catcher.runs():
        k = int(np.searchsorted(starts, s, "right")) - 1
        out[k].append((s - int(starts[k]), e - s, q))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run beyond its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


FOUND = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "collapsed string")


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES,
                  rewrite: Rewrite | None = None) -> DataFrame:
    """Per document: doc_id, n_words, its runs (by start, then period) and the collapsed text: the
    words that no run holds beyond its first period, joined by one space.  ``rewrite`` may put each
    document's words in another order first."""

    def found(rows: list[tuple[int | None, bytes | None]]) -> pa.RecordBatch:
        numbers = _Numbers()
        words, texts = [], []
        for doc_id, text in rows:
            own = (text or b"").split()         # ASCII white space only
            coded = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
            order = rewrite(doc_id, len(own)) if rewrite else None
            if order is not None:
                coded, own = coded[order], [own[i] for i in order.tolist()]
            words.append(own)
            texts.append(coded)
        runs = runs_of_texts(texts, least, times)
        collapsed = []
        for own, has in zip(words, runs):
            if has:
                own = [own[i] for i in np.flatnonzero(kept_words(len(own), has)).tolist()]
            collapsed.append(b" ".join(own))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()),
             pa.array([len(t) for t in texts], pa.int64()),
             pa.array([[{"start": s, "length": n, "period": q} for s, n, q in has]
                       for has in runs], FOUND),
             pa.array(collapsed, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, bytes | None]] = []
        size = 0
        for part in parts:
            texts = part.column(1).cast(pa.binary())
            for doc_id, text in zip(part.column(0).to_pylist(), texts):
                text = text.as_py()
                words = len(text or b"") // 6      # about
                if words > LONG_TEXT:
                    yield found([(doc_id, text)])
                    continue
                held.append((doc_id, text))
                size += words + 1
                if size >= GROUP_WORDS:
                    yield found(held)
                    held, size = [], 0
        if held:
            yield found(held)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        task, SCHEMA)


def repeating_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The rule of op11: by the checksum of its id, a tenth of the documents repeat a stretch of
    their own words from some word on.  None for all other documents."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def op11_periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document: n_runs, the run with the greatest length / period (start, length, period,
    exponent_milli; null without runs) and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, rewrite=repeating_tail)
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # Runs come by start, then period: a later one wins only where it is strictly greater.
    best = F.reduce("runs", none, lambda top, run: F.when(
        top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run
    ).otherwise(top))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"),
                         F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).cast("long")
        .alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
