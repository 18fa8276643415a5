"""Spelling variants: words one edit apart, found by products of letter-count blocks.

Each task counts its words; one row a distinct word and task is shuffled.  Words of the vocabulary
that are one inserted, deleted or replaced code point apart have letter counts whose squared
distance is 1 (lengths one apart) or 2 (equal lengths).  A NumPy product of two blocks of letter
counts (a Gram matrix) gives the squared distances of all their pairs at once:
|u|^2 + |v|^2 - 2 u.v; pairs at two or less in blocks of equal or adjacent length are kept, and
their edits are verified letter by letter.

Which blocks meet: the letters are dealt into four parts.  One edit changes the counts of at most
two letters, so near words agree in all counts of at least two parts.  Each word therefore stands in
six groups, one for every two parts, named by its length and those parts' counts, and again in the
six groups of the length before, where the shorter words await it.  Blocks are multiplied only
inside a group, so the work does not grow with the square of the vocabulary, and nothing is lost.  A
group of more than ``BLOCK`` words is dealt into cells of two blocks, so no task ever holds more than
two blocks of it; groups of a few words are multiplied together, as one block.  A pair that shares
several groups is taken from the first two parts it agrees in.

Edge cases: a null or empty text has no words; a null doc_id leaves its words as they are; repeated
rows count each; equal counts are decided by code point order; words of any length take part; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import is_empty, materialize, mix64
from deltaq.llm.graph import with_cells

LEAST_LENGTH = 5        # code points of a word
LEAST_COUNT = 3         # occurrences of a word
RATIO = 2               # a word's form occurs so many times as often, at least
BLOCK = 2048            # words of a block
MAX_WORDS = 400_000     # words a task remembers before it hands on their counts
TOGETHER = 160          # words of small groups that are multiplied together
WIDE = 64               # longer words are verified one pair at a time

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Letters are dealt into parts by their code points.  One edit changes the counts of at most two
#: letters, so near words agree in AGREE = PARTS - 2 parts at least.
PARTS, AGREE = 4, 2
_LETTERS = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
_PART_OF = np.array([ord(x) % PARTS for x in _LETTERS])
_CODE = np.full(256, -1, np.int64)
_CODE[[ord(x) for x in _LETTERS]] = np.arange(len(_LETTERS))

#: (doc_id, lower-cased words, their numbers in the text) -> number to other word; see planted_typos
Variants = Callable[[int | None, "Words", np.ndarray], Iterator[tuple[int, str]]]


class Words(dict):
    """word as written -> number of its lower-cased form, in order of appearance, with the checksum
    and length in bytes of each form."""

    def __init__(self) -> None:
        super().__init__()
        self.every: list[str] = []
        self._crc = np.zeros(1024, np.uint32)
        self._bytes = np.zeros(1024, np.int64)
        self._done = 0

    def __missing__(self, word: str) -> int:
        lower = word.translate(_LOWER)
        if lower != word:
            number = self[word] = self[lower]
            return number
        number = self[word] = len(self.every)
        self.every.append(word)
        return number

    def checksums(self) -> tuple[np.ndarray, np.ndarray]:
        """(crc32, bytes) of the UTF-8 form of every word."""
        while len(self.every) > len(self._crc):
            self._crc = np.concatenate([self._crc, np.zeros_like(self._crc)])
            self._bytes = np.concatenate([self._bytes, np.zeros_like(self._bytes)])
        new = [w.encode() for w in self.every[self._done:]]
        self._crc[self._done:len(self.every)] = [zlib.crc32(w) for w in new]
        self._bytes[self._done:len(self.every)] = [len(w) for w in new]
        self._done = len(self.every)
        return self._crc, self._bytes


def planted_typos(doc_id: int | None, words: Words, numbers: np.ndarray,
                  ) -> Iterator[tuple[int, str]]:
    """The rule of op12: by the checksum of ``<doc_id>:<word>``, one word in 97 of a document loses
    a code point.  Yields (place among ``numbers``, what the word becomes).  The checksum of a
    prefix and a word is that of the word, combined with one that only the word's length tells."""
    if doc_id is None or not len(numbers):
        return
    crc, size = words.checksums()
    prefix = zlib.crc32(f"{doc_id}:".encode())
    own = size[numbers]
    shift = np.zeros(int(own.max()) + 1, np.uint32)
    for n in np.unique(own).tolist():
        zeros = bytes(n)
        shift[n] = zlib.crc32(zeros, prefix) ^ zlib.crc32(zeros)
    h = shift[own] ^ crc[numbers]
    for at in np.flatnonzero(h % 97 == 0).tolist():
        word = words.every[numbers[at]]
        drop = int(h[at]) % len(word)
        yield at, word[:drop] + word[drop + 1:]


def word_counts(docs: DataFrame, variants: Variants | None = None) -> DataFrame:
    """(word, n) of the maximal runs of letters, A-Z in lower case, of all texts.  ``variants`` may
    replace single words of a document first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        seen = np.zeros(1024, np.int64)

        def flush() -> pa.RecordBatch:
            some = np.flatnonzero(seen[:len(words.every)])
            return pa.RecordBatch.from_arrays(
                [pa.array([words.every[i] for i in some.tolist()], pa.string()),
                 pa.array(seen[some], pa.int64())], ["word", "n"])

        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                found = _RUN.findall(text.as_py() or "")
                numbers = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
                if variants:
                    changed = list(variants(doc_id, words, numbers))
                    for at, other in changed:
                        numbers[at] = words[other] if other else -1
                    numbers = numbers[numbers >= 0] if changed else numbers
                while len(words.every) > len(seen):
                    seen = np.concatenate([seen, np.zeros_like(seen)])
                np.add.at(seen, numbers, 1)
                if len(words) >= MAX_WORDS:
                    yield flush()
                    words = Words()
                    seen = np.zeros(1024, np.int64)
        if words:
            yield flush()

    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _letter_counts(words: list[str], wide: np.dtype = np.dtype(np.int64)) -> np.ndarray:
    """One row of letter counts a word."""
    lengths = np.array([len(w) for w in words], np.int64)
    codes = _CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    at = np.repeat(np.arange(len(words)), lengths) * len(_LETTERS) + codes
    return np.bincount(at, minlength=len(words) * len(_LETTERS)).reshape(
        len(words), len(_LETTERS)).astype(wide)


def _groups(vocabulary: DataFrame) -> DataFrame:
    """(key, parts, longer, word): the groups of each word.  ``parts`` has a bit for each of the
    group's parts, ``longer`` tells the words that are longer than the group's length.  Equal
    counts and lengths have equal keys; what only shares a key is told apart by the counts."""
    combinations = [sum(1 << k for k in some) for some in itertools.combinations(range(PARTS), AGREE)]

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mix64(np.arange(1, len(_LETTERS) + 1))
        for part in parts:
            words = part.column(0).to_pylist()
            for a in range(0, len(words), 4096):
                some = pa.array(words[a:a + 4096], pa.string())
                counts = _letter_counts(words[a:a + 4096])
                size = counts.sum(1)
                sums = [(counts[:, _PART_OF == k].astype(np.uint64) * weights[_PART_OF == k]).sum(1)
                        for k in range(PARTS)]
                for bits in combinations:
                    own = sum(sums[k] for k in range(PARTS) if bits >> k & 1)
                    for longer in (False, True):
                        key = mix64(own ^ mix64((size - longer) * 64 + bits))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), pa.array(np.full(len(some), bits, np.int32)),
                             pa.array(np.full(len(some), longer)), some],
                            ["key", "parts", "longer", "word"])

    return vocabulary.select("word").mapInArrow(
        place, "key long, parts int, longer boolean, word string")


def squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of all pairs of two blocks of letter counts, times -1/2, by one product: the counts beside
    their own half squares, u.v - |u|^2 / 2 - |v|^2 / 2."""
    most = max(left.sum(1).max(initial=0), right.sum(1).max(initial=0))
    kind = np.float32 if most < 2000 else np.float64       # exact: sums below 2**22 and 2**51
    a = np.empty((len(left), left.shape[1] + 2), kind)
    b = np.empty((len(right), right.shape[1] + 2), kind)
    a[:, :-2], b[:, :-2] = left, right
    a[:, -2], a[:, -1] = (a[:, :-2] ** 2).sum(1) / -2, 1
    b[:, -2], b[:, -1] = 1, (b[:, :-2] ** 2).sum(1) / -2
    return a @ b.T


def one_edit(a: str, b: str) -> bool:
    """Whether one code point inserted, deleted or replaced makes a word of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _verified(words: list[str], letters: np.ndarray | None, i: np.ndarray, j: np.ndarray,
              ) -> np.ndarray:
    """``one_edit`` of many pairs, words[i] no longer than words[j]; ``letters`` has the words' code
    points in rows, padded with 0, where they are not too wide for that."""
    if letters is None:
        return np.array([one_edit(words[a], words[b]) for a, b in zip(i, j)], bool)
    x, y = letters[i], letters[j]
    differ = x != y
    many = differ.sum(1)
    replaced = (many == 1) & ((x > 0).sum(1) == (y > 0).sum(1))
    # Inserted: from the first difference on, the same letters again, one place further.
    first = differ.argmax(1)
    behind = np.zeros_like(y)
    behind[:, :-1] = y[:, 1:]
    after = np.arange(letters.shape[1]) >= first[:, None]
    inserted = (many > 0) & ~replaced & ~((x != behind) & after).any(1)
    return replaced | inserted


def _letters(words: list[str]) -> np.ndarray | None:
    n = max(map(len, words), default=1)
    if n > WIDE:
        return None
    return np.array([w.encode("latin-1") for w in words], f"S{n}").view(np.uint8).reshape(-1, n)


def _pairs_of_cell(words: list[str], group: np.ndarray, parts: np.ndarray, longer: np.ndarray,
                   blocks: np.ndarray, low: int, high: int,
                   ) -> Iterator[tuple[list[str], list[str]]]:
    """Near pairs of a cell: block ``low`` against block ``high``, inside each of its groups."""
    counts = _letter_counts(words)
    size = counts.sum(1)
    letters = _letters(words)
    bits = 1 << np.arange(PARTS)
    # Sums that tell the parts' counts apart wherever at most two letters differ, by one each.
    sums = np.stack([counts[:, _PART_OF == k] @ (np.flatnonzero(_PART_OF == k) + 1)
                     for k in range(PARTS)], 1)
    for n, (p, q) in enumerate([(low, high)] if low == high else [(low, high), (high, low)]):
        left = np.flatnonzero(~longer & (blocks == p))
        for other_length in (False, True):
            if n and not other_length:      # equal lengths: each two blocks meet once
                continue
            right = np.flatnonzero((longer == other_length) & (blocks == q))
            # Rows at a time, so that no product exceeds BLOCK x BLOCK places.
            for a in range(0, len(left), BLOCK):
                some = left[a:a + BLOCK]
                for b in range(0, len(right), BLOCK):
                    other = right[b:b + BLOCK]
                    i, j = np.nonzero(squared_distances(counts[some], counts[other]) >= -1)
                    i, j = some[i], other[j]
                    keep = (group[i] == group[j]) & (parts[i] == parts[j])
                    keep &= size[j] - size[i] == int(other_length)
                    if not other_length and low == high:
                        keep &= i < j
                    i, j = i[keep], j[keep]
                    # The group of the first parts that agree has the pair, no other.
                    agree = sums[i] == sums[j]
                    agree &= np.cumsum(agree, 1) <= AGREE
                    keep = (agree * bits).sum(1) == parts[i]
                    i, j = i[keep], j[keep]
                    ok = _verified(words, letters, i, j)
                    if ok.any():
                        yield ([words[k] for k in i[ok].tolist()],
                               [words[k] for k in j[ok].tolist()])


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Which of some ordered rows are the first of their key."""
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = False
        for k in keys:
            column = rows.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
    return new


def _whole_cells(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Ordered rows, many at a time, cut where a cell ends, without the cells of one row."""
    held: list[pa.RecordBatch] = []

    def paired(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        alone = starts & np.append(starts[1:], True)
        return rows.filter(pa.array(~alone))

    for part in parts:
        if not part.num_rows:
            continue
        held.append(part)
        rows = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(rows, keys)
        last = int(np.flatnonzero(starts)[-1])
        if last:
            yield paired(rows.slice(0, last), starts[:last])
            held = rows.slice(last).combine_chunks().to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield paired(rows, _starts(rows, keys))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(a, b), both orders, of the distinct words of a vocabulary (column ``word``) that one
    inserted, deleted or replaced code point sets apart."""
    groups = materialize(_groups(vocabulary), "spelling-groups")
    # Only groups of more than a block are dealt over cells; there are at most as many of them as
    # the groups' rows hold blocks.
    sizes = materialize(groups.groupBy("key").agg(F.count("*").alias("_size"))
                        .filter(F.col("_size") > BLOCK), "spelling-sizes")
    dealt = with_cells(groups.join(sizes, "key", "left"), F.coalesce("_size", F.lit(1)),
                       F.col("word"), BLOCK).select("key", "_i", "_j", "_b", "parts", "longer", "word")
    order = ["key", "_i", "_j"]

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _whole_cells(rows, order):
            if not len(cells):
                continue
            words = cells.column("word").to_pylist()
            parts, longer, blocks, i, j = (
                cells.column(c).to_numpy() for c in ("parts", "longer", "_b", "_i", "_j"))
            starts = _starts(cells, order)
            group = np.cumsum(starts) - 1
            edges = np.append(np.flatnonzero(starts), len(cells))
            at = 0
            while at < len(edges) - 1:      # small groups of one block are multiplied together
                begin, upto = edges[at], at + 1
                if not j[begin]:
                    most = int(np.searchsorted(edges, begin + TOGETHER, "right")) - 1
                    split = np.flatnonzero(j[edges[at:max(most, upto)]])
                    upto = max(upto, at + int(split[0]) if len(split) else most)
                end, at = edges[upto], upto
                some = slice(begin, end)
                for x, y in _pairs_of_cell(words[some], group[some], parts[some], longer[some],
                                           blocks[some], int(i[begin]), int(j[begin])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x + y, pa.string()), pa.array(y + x, pa.string())], ["a", "b"])

    return (dealt.repartition(*order).sortWithinPartitions(*order)
            .mapInArrow(compare, "a string, b string"))


def spelling_forms(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """For a vocabulary (word, n): word, n, its form (the near word that occurs most often, where
    that is at least ``ratio`` times as often), the root that forms lead to, n_near and form_n."""
    vocabulary = materialize(vocabulary.select("word", "n"), "spelling-vocabulary")
    links = materialize(near_words(vocabulary), "spelling-links")
    other = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("_n"))
    # The largest count, then the smallest word: Spark orders strings by their UTF-8 bytes, which is
    # the order of code points.
    best = links.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("_n")).alias("_n"), F.col("b"))).alias("_best"))
    chosen = F.when(-F.col("_best._n") >= ratio * F.col("n"), F.col("_best"))
    forms = materialize(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        chosen["b"].alias("form"), (-chosen["_n"]).alias("form_n")), "spelling-forms")
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form.  Each round every word takes its form's form for its
    own, so the rounds are the logarithm of the longest chain; counts rise along a chain, so it
    ends."""
    at = materialize(forms.filter("form is not null").select("word", F.col("form").alias("root")),
                     "spelling-roots")
    while True:
        above = at.select(F.col("word").alias("root"), F.col("root").alias("_above"))
        if is_empty(at.join(above, "root", "left_semi")):
            return at
        at = materialize(at.join(above, "root", "left").select(
            "word", F.coalesce("_above", "root").alias("root")), "spelling-roots")


def op12_spelling_groups(docs: DataFrame) -> DataFrame:
    counts = word_counts(docs, planted_typos).filter(
        (F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))
    return spelling_forms(counts)
