"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features are words (runs of letters, lower case) and the beginnings of longer words, which stand for
stems, hashed to ``BINS`` numbers; a feature's value is log(1 + times it occurs).  One weight per feature is shared by all thresholds: with s = w . x the
probability of a grade above k is sigmoid(s - theta_k), with theta_0 < theta_1 < ...  The expected
severity is the sum of these probabilities; a text is called toxic where a grade above 0 is likelier
than not.

The model is fitted on at most ``SAMPLE`` labelled documents (a parameter), taken by a keyed digest
of their ids over the whole label table; copies of a text count once.  Where labels have no ``grade``
but only ``toxic``, grades are derived: 0 for clean texts, and for toxic ones 1, 2 and 3 by how often words
that mark toxic texts occur (thirds of the toxic texts).  Only words and
stems whose share among toxic and clean texts differs clearly (likelihood ratio, counted in a first
pass) become features.  The descent runs in one task on the bounded sample's features, scoring in
every task on whole texts.

Edge cases: null and empty texts have no features and get the severity that the thresholds imply;
null labels are passed over, and of several labels of a document the highest counts; without
labels of both kinds nothing is called toxic; repeated rows are scored alike; null ids are scored
like others; empty tables give empty results; other columns are ignored or handed through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import hand_back, materialize, ship, table

BINS = 1 << 20
SAMPLE = 20_000
GRADES = 3              # grades above 0 that are derived from toxic labels
STEMS = (4, 5, 6, 7, 8)  # lengths of the beginnings of longer words
CLEAR = 25.0            # likelihood ratio from which a word or stem is a feature
LEAST_TEXTS = 3         # texts that a feature occurs in
STEPS = 1500
RATE = 0.05
DECAY = 2e-6
MAX_WORDS = 200_000     # words a task remembers
LONG = 1 << 22          # characters from which a text is very long

_LETTERS = re.compile(r"[^\W\d_]+")


def word_bins(word: str) -> tuple[int, ...]:
    """Feature numbers of a word: its own and those of its stems."""
    stems = [word[:n] + "*" for n in STEMS if n < len(word)]
    return tuple(xxhash.xxh3_64_intdigest(x) % BINS for x in [word, *stems])


def _word_counts(text: str) -> Counter[str]:
    """Words of a text; of a very long one without holding the list of them."""
    if len(text) <= LONG:
        return Counter(_LETTERS.findall(text))
    return Counter(m.group() for m in _LETTERS.finditer(text))


class Features:
    """Feature numbers of texts; remembers words.  ``only``: the numbers that count, if not all."""

    def __init__(self, only: np.ndarray | None = None) -> None:
        self.only = None if only is None else set(only.tolist())
        self.words: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> Counter[int]:
        """How often each feature occurs in a text."""
        if len(self.words) > MAX_WORDS:
            self.words = {}
        found: Counter[int] = Counter()
        for word, n in _word_counts((text or "").lower()).items():
            bins = self.words.get(word)
            if bins is None:
                bins = word_bins(word)
                if self.only is not None:
                    bins = tuple(b for b in bins if b in self.only)
                self.words[word] = bins
            for b in bins:
                found[b] += n
        return found


@dataclass
class Model:
    """Weights of the features (sorted numbers) and the ordered thresholds."""

    bins: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """Probability of a grade above k, per score and k."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


# ---- fitting -------------------------------------------------------------------------------

def sample_labels(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, y): at most ``most`` labelled documents, by a digest of their ids."""
    grade = "grade" if "grade" in labels.columns else "toxic"
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col(grade).cast("int").alias("y")).dropna()
    return (y.groupBy("doc_id").agg(F.max("y").alias("y"))
            .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(most))


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Fit on the texts of a bounded sample of labelled documents."""
    graded = "grade" in labels.columns
    chosen = sample_labels(labels, most)
    # At most ``most`` rows of 12 bytes; copies of a text count once, with their highest label.
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
             .join(F.broadcast(chosen), "doc_id")
             .groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("_digest"))
             .agg(F.max("y").alias("y"), F.first("text").alias("text")))
    texts = materialize(texts, "toxicity-sample")
    seen = texts.agg(F.count(F.when(F.col("y") > 0, 1)).alias("toxic"),
                     F.count(F.when(F.col("y") <= 0, 1)).alias("clean")).first()
    if not seen["toxic"] or not seen["clean"]:
        return _nothing()
    clear = _clear_features(texts, seen["toxic"], seen["clean"])

    def sparse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, marked = Features(clear[:, 0]), set(clear[clear[:, 1] > 0, 0].tolist())
        for part in parts:
            found = [every.of(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_digest"), part.column("y"),
                 pa.array([np.fromiter(x.keys(), np.int32, len(x)).tobytes() for x in found],
                          pa.binary()),
                 pa.array([np.fromiter(x.values(), np.int32, len(x)).tobytes() for x in found],
                          pa.binary()),
                 pa.array([float(sum(np.log1p(n) for b, n in x.items() if b in marked))
                           for x in found], pa.float64())],
                names=["id", "y", "bins", "counts", "marks"])

    def train(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [part for part in parts if part.num_rows]
        model = fit_rows(pa.Table.from_batches(rows), graded) if rows else _nothing()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.tobytes()], pa.binary()) for m in
             (model.bins.astype(np.int32), model.weights, model.thresholds)],
            names=["bins", "weights", "thresholds"])

    # An id may be repeated in the documents: the bound holds for texts as well.
    rows = texts.mapInArrow(
        sparse, "id string, y int, bins binary, counts binary, marks double").orderBy("id").limit(
        most)
    model = (rows.repartition(1).sortWithinPartitions("id")
             .mapInArrow(train, "bins binary, weights binary, thresholds binary").first())
    return Model(np.frombuffer(model["bins"], np.int32),
                 np.frombuffer(model["weights"], np.float64),
                 np.frombuffer(model["thresholds"], np.float64))


def _clear_features(texts: DataFrame, toxic: int, clean: int) -> np.ndarray:
    """Rows (feature, marks): features whose share differs clearly between toxic and clean texts;
    ``marks`` is 1 for those of toxic texts.  At most ``BINS`` by their hashing."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BINS), np.int32)
        every = Features()
        for part in parts:
            for text, y in zip(part.column("text"), part.column("y").to_pylist()):
                found = every.of(text.as_py())
                seen[int(y > 0), np.fromiter(found.keys(), np.int64, len(found))] += 1
        some = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(seen[1, some].astype(np.int64)),
             pa.array(seen[0, some].astype(np.int64))], names=["bin", "a", "c"])
        del every, seen
        hand_back()

    counts = (texts.select("text", "y").mapInArrow(count, "bin int, a long, c long")
              .groupBy("bin").agg(F.sum("a").alias("a"), F.sum("c").alias("c"))
              .filter(F.col("a") + F.col("c") >= LEAST_TEXTS))
    n1, n0 = F.lit(float(toxic)), F.lit(float(clean))
    total = F.col("a") + F.col("c")

    def term(seen, share):
        expected = share / (n1 + n0)
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (term(F.col("a"), total * n1) + term(F.col("c"), total * n0)
                 + term(n1 - F.col("a"), (n1 + n0 - total) * n1)
                 + term(n0 - F.col("c"), (n1 + n0 - total) * n0))
    marks = (F.col("a") + 0.5) / (n1 + 1) > 4 * (F.col("c") + 0.5) / (n0 + 1)
    found = counts.filter(ratio >= CLEAR).select("bin", marks.cast("int").alias("marks")).orderBy(
        "bin").toPandas()
    return found.to_numpy(np.int32).reshape(-1, 2)


def _nothing() -> Model:
    return Model(np.zeros(0, np.int32), np.zeros(0), np.full(1, 40.0))


def fit_rows(rows: pa.Table, graded: bool) -> Model:
    """Fit on rows (y, bins, counts, marks) of one bounded sample."""
    bins = [np.frombuffer(b, np.int32) for b in rows.column("bins").to_pylist()]
    counts = [np.frombuffer(n, np.int32) for n in rows.column("counts").to_pylist()]
    y, marks = rows.column("y").to_numpy(), rows.column("marks").to_numpy()
    toxic = y > 0
    if toxic.all() or not toxic.any():
        return _nothing()
    row = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    names, column = np.unique(np.concatenate(bins), return_inverse=True)
    times = np.concatenate(counts).astype(np.float64)
    if not graded:
        cuts = np.quantile(marks[toxic], np.arange(1, GRADES) / GRADES)
        y = np.where(toxic, 1 + np.searchsorted(cuts, marks, side="right"), 0)
    weights, thresholds = _descend(row, column, np.log1p(times), y, len(names))
    return Model(names.astype(np.int32), weights, thresholds)


def _descend(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, n: int,
             ) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient descent with adaptive steps: the first threshold
    and the logarithms of the gaps are free, so the order holds by itself."""
    top = int(y.max())
    reached = np.array([(y > k).mean() for k in range(top)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - reached) / reached)
    free = np.concatenate([np.zeros(n), start[:1],
                           np.log(np.maximum(np.diff(start), 0.1))])
    first, second = np.zeros_like(free), np.zeros_like(free)
    m = len(y)
    for step in range(1, STEPS + 1):
        w, gaps = free[:n], np.exp(free[n + 1:])
        theta = free[n] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.bincount(row, value * w[column], m)
        # Bounds of each grade: P(grade) = F(high) - F(low), F the logistic function.
        high = np.where(y < top, theta[np.minimum(y, top - 1)] - s, 60.0)
        low = np.where(y > 0, theta[np.maximum(y, 1) - 1] - s, -60.0)
        f_high, f_low = _sigmoid(high), _sigmoid(low)
        p = np.maximum(f_high - f_low, 1e-12)
        d_high = np.where(y < top, f_high * (1 - f_high), 0) / p
        d_low = np.where(y > 0, f_low * (1 - f_low), 0) / p
        d_s = (d_high - d_low) / m                      # of the negative log likelihood
        d_theta = (np.bincount(np.maximum(y, 1) - 1, np.where(y > 0, d_low, 0), top)
                   - np.bincount(np.minimum(y, top - 1), np.where(y < top, d_high, 0), top)) / m
        after = np.cumsum(d_theta[::-1])[::-1]          # a gap moves all thresholds above it
        gradient = np.concatenate([np.bincount(column, value * d_s[row], n) + DECAY * w,
                                   after[:1], after[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        free = free - RATE * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    gaps = np.exp(free[n + 1:])
    return free[:n], free[n] + np.concatenate([[0.0], np.cumsum(gaps)])


# ---- scoring -------------------------------------------------------------------------------

class Scorer:
    """Scores whole texts."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.features = Features(model.bins)

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return np.array([self._score(t) for t in texts], np.float64)

    def _score(self, text: str | None) -> float:
        found = sorted(self.features.of(text).items())
        if not found:
            return 0.0
        bins, times = np.array(found).T
        return float((self.model.weights[np.searchsorted(self.model.bins, bins)]
                      * np.log1p(times)).sum())


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic) of every row."""

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part in parts:
            above = model.above(scorer.scores(t.as_py() for t in part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(above.sum(axis=1)),
                 pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array(above[:, 0]),
                 pa.array(above[:, 0] >= 0.5)],
                names=["doc_id", "severity", "grade", "p_toxic", "toxic"])
        del scorer
        hand_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        score, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are not called toxic, with the columns of ``docs``."""
    at = docs.columns.index(text)

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part in parts:
            above = model.above(scorer.scores(t.as_py() for t in part.column(at)))
            yield part.filter(pa.array(above[:, 0] < 0.5))
        del scorer
        hand_back()

    return docs.mapInArrow(keep, docs.schema)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Fit on ``labels``, grade every row of ``documents``."""
    docs = table(ship(spark), sf_dir, "documents")
    return grade(docs, fit(docs, table(spark, sf_dir, "labels")))
