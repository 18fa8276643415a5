"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document's set holds the hashes (64 bits) of its distinct 5-word shingles; documents with equal
sets are one node, numbered for itself and standing for its smallest doc_id.  Every node has 128 minwise tokens.  Each of
a threshold's independent trees deals the nodes by chosen tokens: at a tree node one position, and
with probability 1 / threshold - 1 a second, is chosen, the same for all that are there, and each
document goes to the child of its token at that position.  A node of the first level that is one
dense group is not branched, as no token splits it.  Documents that share no token with any other leave
the tree; a child with few documents is compared exhaustively; a larger one branches again.  What
is still large at the last level is dealt over blocks that are compared pair by pair of blocks, so
nothing is capped.

Comparison reads signatures first (agreeing tokens), then full sets: a link needs
100 * |intersection| >= percent * |union| of the sets themselves.  The percentage is a parameter, 85
for the registered query and 80 for the pipeline's stage; see ``Threshold`` for what hangs on it.  It runs in two passes.  The first takes
one partner per document in each small set, the most similar one before it, which unites dense
groups with few pairs.  The second looks at all pairs in different components: signatures name the
documents that have any such partner, these get their exact difference from one document of their
small set (few hashes among near copies), and from the differences every pair's intersection
follows exactly inside the cell, which hands on a spanning forest of its links.  So no group is
expanded into all its pairs, and no link between components is lost.

Recall: at 85 per cent a pair at the threshold survives a level of one tree with probability 0.87, so
it misses all ten trees with about 1e-9 at one level and 2e-4 at four; at 80 per cent it survives a
level with 0.84, and there are twelve trees for the same recall.

Edge cases: null and empty texts and those without words have an empty set and link with nothing;
texts of fewer than 5 words are one shingle; very long texts are read in segments; a null doc_id
takes no part (component_id null, kept true), the filter holds such rows against each other; an id
repeated with other texts is a document per set, so components that are not linked may bear the same
component_id, and kept is true for the smallest doc_id's (smallest key's) rows of each; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import hand_back, is_empty, materialize, mix64
from deltaq.llm.graph import connected_components, forest, runs, with_cells

WORDS = 5
PERCENT = 85
TOKENS = 128            # minwise tokens per document
LEVELS = 4
MISSES = 4.1e-5         # chance, second positions at every level, that a pair misses all trees
SMALL = 256             # documents that are compared exhaustively, and block size beyond
#: Ids up to this many (8 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_IDS = 200_000
BROADCAST_NODES = 10_000    # rows of 0.5 kB
DENSE = 0.5             # share of a node's documents like its middle one from which it is not branched
CANDIDATES = 16         # documents of a large node of which one is its middle one
SEGMENT = 1 << 22
MAX_WORDS = 100_000     # word hashes a worker remembers

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_POWERS = np.array([pow(_STEP, k, 1 << 64) for k in range(WORDS)], np.uint64)
_MULTIPLIERS = mix64(np.arange(1, TOKENS + 1, dtype=np.uint64) * _GOLD) | np.uint64(1)


@dataclass(frozen=True)
class Threshold:
    """What hangs on the similarity, in per cent, from which documents are linked."""

    percent: int = PERCENT

    @property
    def agree(self) -> int:
        """Agreeing tokens (of 128) from which a pair is verified: 3.8 deviations below."""
        x = self.percent / 100
        return round(TOKENS * (x - 3.8 * (x * (1 - x) / TOKENS) ** 0.5))

    @property
    def second(self) -> float:
        """Probability of a second position, with which a pair goes on in one child on average."""
        return 100 / self.percent - 1

    @property
    def trees(self) -> int:
        """As many as leave a pair at the threshold a chance of ``MISSES`` after all levels."""
        found = 1.0
        for _ in range(LEVELS):
            missed = 1 - self.percent / 100 * found
            found = 1 - (1 - self.second) * missed - self.second * missed ** 2
        return math.ceil(math.log(MISSES) / math.log(1 - found))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _hash_words(segment: bytes) -> np.ndarray:
    words = segment.lower().split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of a text's words, A-Z in lower case."""
    if len(_HASHES) > MAX_WORDS:
        _HASHES.clear()
    if len(text) <= SEGMENT:
        return _hash_words(text)
    parts, at = [], 0
    while at < len(text):
        end = min(at + SEGMENT, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        parts.append(_hash_words(text[at:end]))
        at = end
    return np.concatenate(parts)


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = word_hashes(text or b"")
    if len(w) == 0:
        return w
    size = min(len(w), WORDS)
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h += w[k:len(w) - size + 1 + k] * _POWERS[k]
    return np.unique(mix64(h))


def minwise(s: np.ndarray) -> np.ndarray:
    """One 32-bit minwise token per multiplier."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        least = np.minimum(least, (s[at:at + 4096, None] * _MULTIPLIERS[None, :]).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, tokens): key is a digest of the set, tokens are the minwise ones;
    both null for an empty set."""

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, keys, tokens = [], [], []
            for text in part.column(1):
                s = shingles(text.as_py())
                sizes.append(len(s))
                keys.append(_key(s) if len(s) else None)
                tokens.append(minwise(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(tokens, pa.binary())], names=["doc_id", "n_shingles", "key", "tokens"])
        _HASHES.clear()
        hand_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")
                       ).mapInArrow(
        sketch, "doc_id long, n_shingles long, key binary, tokens binary")


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _child(node: np.ndarray, seed: np.ndarray, position: np.ndarray,
           tokens: np.ndarray) -> np.ndarray:
    return mix64(node * _GOLD + seed + tokens.astype(np.uint64) * np.uint64(_STEP)
                 + position.astype(np.uint64))


def _roots(tokens: np.ndarray, at: Threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, child) of the first level: trees choose different positions."""
    rows = np.arange(len(tokens))
    second, trees = at.second, at.trees
    step = TOKENS // trees
    for tree in range(trees):
        seed = mix64(np.array([tree + 1], np.uint64))
        wide = (mix64(seed)[0] >> np.uint64(40)) / (1 << 24) < second
        for position in (tree * step, tree * step + step // 2)[:1 + wide]:
            yield rows, _child(seed, seed, np.array([position]), tokens[:, position])


def _below(node: np.ndarray, tokens: np.ndarray, at: Threshold,
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, child) of each row's chosen paths below its tree node."""
    rows = np.arange(len(node))
    seed = mix64(node + _GOLD)
    again = mix64(seed + _GOLD)
    wide = (mix64(again ^ _GOLD) >> np.uint64(40)).astype(np.float64) / (1 << 24) < at.second
    for s, r in ((seed, rows), (again, rows[wide])):
        position = (s[r] % np.uint64(TOKENS)).astype(np.int64)
        yield r, _child(node[r], s[r], position, tokens[r, position])


def _branch(parts: Iterator[pa.RecordBatch], roots: bool, at: Threshold,
            ) -> Iterator[pa.RecordBatch]:
    """Rows (rep, tokens[, node]) to rows (node, rep) one level deeper."""
    for part in parts:
        if part.num_rows == 0:
            continue
        rep = part.column("rep").to_numpy()
        tokens = np.frombuffer(b"".join(part.column("tokens").to_pylist()), np.uint32).reshape(
            len(rep), TOKENS)
        paths = _roots(tokens, at) if roots else _below(
            part.column("node").to_numpy().view(np.uint64), tokens, at)
        for rows, child in paths:
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), pa.array(rep[rows])], names=["node", "rep"])


def _sized(paths: DataFrame) -> DataFrame:
    """Tree nodes with company: (node, rep, size, first).  Both sides read the written paths, so
    the branching behind them is done once."""
    paths = materialize(paths, "branches")
    sizes = paths.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("first"))
    return paths.join(sizes.filter("size > 1"), "node")


def _tokens(rows: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(column).to_pylist()), np.uint32).reshape(-1, TOKENS)


def middles(large: DataFrame, tokens: DataFrame, at: Threshold) -> DataFrame:
    """(node, middle, _middle): of a few documents of each large tree node, drawn by hashes of their
    ids, the one that most of them are like, and its tokens."""
    drawn = large.groupBy("node").agg(*[
        F.min_by("rep", F.xxhash64("rep", F.lit(i))).alias(f"_{i}") for i in range(CANDIDATES)])
    drawn = drawn.select("node", F.explode(F.array_distinct(F.array(
        *[f"_{i}" for i in range(CANDIDATES)]))).alias("rep"))
    cells = (drawn.join(tokens, "rep").select("node", "rep", "tokens").repartition("node")
             .sortWithinPartitions("node", "rep"))

    def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(parts, ["node"]):
            t = _tokens(cell, "tokens")
            like = ((t[:, None, :] == t[None, :, :]).sum(2) >= at.agree).sum(1)
            best = int(like.argmax())
            yield pa.RecordBatch.from_arrays(
                [cell.column(c).slice(best, 1).combine_chunks() for c in ("node", "rep", "tokens")],
                names=["node", "middle", "_middle"])

    return cells.mapInArrow(pick, "node long, middle long, _middle binary")


def dense_nodes(large: DataFrame, tokens: DataFrame, at: Threshold) -> DataFrame:
    """(node, middle): large tree nodes most of whose documents are like their middle one.  Such a group
    shares nearly all tokens, so no choice of tokens would split it: it is compared in blocks, like
    what is still large at the last level, instead of being dragged through all levels.  Any one
    document may lie at the group's edge and be like few of it, so it is not judged by its first."""
    middle = materialize(middles(large, tokens, at), "node-middles")
    # One row a large node, so at most one for every SMALL rows of the level.
    few = middle.count() <= BROADCAST_NODES
    rows = large.select("node", "rep").join(tokens, "rep").join(
        F.broadcast(middle) if few else middle, "node").select(
        "node", "middle", "tokens", "_middle")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                x, y = _tokens(part, "tokens"), _tokens(part, "_middle")
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("middle"),
                     pa.array((x == y).sum(1) >= at.agree)], names=["node", "middle", "alike"])

    return (rows.mapInArrow(compare, "node long, middle long, alike boolean")
            .groupBy("node", "middle").agg(F.avg(F.col("alike").cast("int")).alias("_share"))
            .filter(F.col("_share") >= DENSE).select("node", "middle"))


def united_nodes(rows: DataFrame, dense: DataFrame, tokens: DataFrame, at: Threshold) -> DataFrame:
    """(node, rep, size, first) of the rows (node, rep) of dense nodes.  A group of near copies is a
    dense node of nearly every tree: nodes of which one holds the other's middle document, like its
    own, become one, so that a pair of documents is compared once and not once a tree.  ``first`` is
    the middle document of one of them."""
    # A middle document is in few nodes, as it has few paths in each tree.
    held = rows.join(dense.select(F.col("node").alias("_a"), F.col("middle").alias("rep")), "rep")
    held = held.filter("_a <> node").join(dense, "node").select(
        F.col("_a").alias("a"), F.col("node").alias("b"), "rep", "middle")
    x, y = tokens.withColumnRenamed("tokens", "_x"), tokens.select(
        F.col("rep").alias("middle"), F.col("tokens").alias("_y"))
    held = held.join(x, "rep").join(y, "middle").select("a", "b", "_x", "_y")

    def alike(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                same = (_tokens(part, "_x") == _tokens(part, "_y")).sum(1)
                yield part.select(["a", "b"]).filter(pa.array(same >= at.agree))

    links = materialize(held.mapInArrow(alike, "a long, b long"), "node-links")
    parts = materialize(dense.join(connected_components(links), F.col("node") == F.col("vertex"),
                                   "left").select(
        "node", F.coalesce("component", "node").alias("_one"), "middle"), "node-parts")
    few = parts.count() <= BROADCAST_IDS
    parts = F.broadcast(parts) if few else parts
    one = materialize(rows.select("node", "rep").join(parts.select("node", "_one"), "node").select(
        F.col("_one").alias("node"), "rep").distinct(), "dense-rows")
    sizes = one.groupBy("node").agg(F.count("*").alias("size")).join(
        parts.filter("node = _one").select("node", F.col("middle").alias("first")), "node")
    return one.join(F.broadcast(sizes) if few else sizes, "node").select(
        "node", "rep", "size", "first")


def chosen_paths(reps: DataFrame, at: Threshold) -> DataFrame:
    """(node, rep, size, first): the leaves of all trees that hold more than one document."""
    tokens = reps.select("rep", "tokens")
    level = materialize(_sized(tokens.mapInArrow(
        lambda parts: _branch(parts, True, at), "node long, rep long")), "paths")
    leaves = level.filter(F.col("size") <= SMALL)
    dense = materialize(dense_nodes(level.filter(F.col("size") > SMALL), tokens, at), "dense")
    if not is_empty(dense):
        # At most one row for every SMALL of the level's.
        few = dense.count() <= BROADCAST_IDS
        nodes = F.broadcast(dense.select("node")) if few else dense.select("node")
        leaves = leaves.unionByName(united_nodes(
            level.join(nodes, "node", "left_semi").select("node", "rep"), dense, tokens, at))
        level = level.join(nodes, "node", "left_anti")
    for depth in range(1, LEVELS):
        large = level.filter(F.col("size") > SMALL)
        if is_empty(large):
            return leaves
        below = large.select("node", "rep").join(tokens, "rep").mapInArrow(
            lambda parts: _branch(parts, False, at), "node long, rep long")
        level = materialize(_sized(below), "paths")
        leaves = leaves.unionByName(level if depth == LEVELS - 1
                                    else level.filter(F.col("size") <= SMALL))
    return leaves


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Agreeing positions of one-byte tokens, for all pairs of two short lists."""
    out = np.empty((len(x), len(y)), np.int16)
    for at in range(0, len(x), 32):
        out[at:at + 32] = (x[at:at + 32, None, :] == y[None, :, :]).sum(axis=2, dtype=np.int16)
    return out


def _sketches(cell: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(cell.column("sketch").to_pylist()), np.uint8).reshape(
        len(cell), TOKENS)


def partners(leaves: DataFrame, sketches: DataFrame, at: Threshold) -> DataFrame:
    """First pass, distinct (a, b): for each document of a small set, the most similar one before it,
    by id after the set's first document.  Large sets are cut into blocks, each with that added."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / SMALL)).cast("int")
    later = (F.col("rep") != F.col("first")).alias("_later")
    own = leaves.select("node", "rep", F.pmod(F.xxhash64("rep", F.lit(5)), blocks).cast("int")
                        .alias("block"), later)
    pivot = leaves.filter((F.col("rep") == F.col("first")) & (F.col("size") > SMALL)).select(
        "node", "rep", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), later)
    cells = (own.unionByName(pivot).distinct().join(sketches, "rep")
             .repartition("node", "block").sortWithinPartitions("node", "block", "_later", "rep"))
    enough = at.agree

    def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(parts, ["node", "block"]):
            if len(cell) < 2:
                continue
            rep, s = cell.column("rep").to_numpy(), _sketches(cell)
            agree = np.tril(_agreement(s, s), -1)       # with those before it
            best = agree.argmax(axis=1)
            some = agree[np.arange(len(rep)), best] >= enough
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[best[some]]), pa.array(rep[some])], names=["a", "b"])

    return cells.mapInArrow(pick, "a long, b long").filter("a <> b").distinct()


def _largest_part(rows: DataFrame) -> DataFrame:
    """(node, _main, _n_main, _parts): the component with most of a node's rows, their number, and
    the number of components.  Its rows need not be compared with each other."""
    return rows.groupBy("node", "component").agg(F.count("*").alias("_c")).groupBy("node").agg(
        F.max(F.struct("_c", "component")).alias("_most"), F.count("*").alias("_parts")).select(
        "node", F.col("_most.component").alias("_main"), F.col("_most._c").alias("_n_main"),
        "_parts")


def remaining(leaves: DataFrame, sketches: DataFrame, component: DataFrame,
              at: Threshold) -> DataFrame:
    """Second pass, distinct (node, rep, component): documents with a similar enough signature in
    another component, per small set."""
    c = component.withColumnRenamed("vertex", "rep")
    rows = leaves.join(c, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    rows = rows.join(_largest_part(rows).filter("_parts > 1"), "node").join(sketches, "rep")
    order = ["node", "_i", "_j"]
    cells = (with_cells(rows, F.col("size"), F.col("rep"), SMALL,
                        F.col("component") == F.col("_main"), F.col("_n_main"))
             .select(*order, "_b", "rep", "component", "sketch").repartition(*order)
             .sortWithinPartitions(*order))
    enough = at.agree

    def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(parts, order):
            i, j = cell.column("_i")[0].as_py(), cell.column("_j")[0].as_py()
            rep, s = cell.column("rep").to_numpy(), _sketches(cell)
            comp, b = cell.column("component").to_numpy(), cell.column("_b").to_numpy()
            left, right = np.flatnonzero(b == i), np.flatnonzero(b == j)
            alike = ((_agreement(s[left], s[right]) >= enough)
                     & (comp[left][:, None] != comp[right][None, :]))
            some = np.unique(np.concatenate([left[alike.any(axis=1)], right[alike.any(axis=0)]]))
            if len(some):
                node = cell.column("node")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), node)), pa.array(rep[some]),
                     pa.array(comp[some])], names=["node", "rep", "component"])

    return cells.mapInArrow(pick, "node long, rep long, component long").distinct()


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, pivot, base, lacks, adds): a set as its exact difference from the pivot's set."""
    own = sets.select("rep", F.col("set").alias("_own"))
    other = sets.select(F.col("rep").alias("pivot"), F.col("set").alias("_pivot"))

    def differ(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            base, lacks, adds = [], [], []
            for x, y in zip(part.column("_own"), part.column("_pivot")):
                s, p = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                base.append(len(p))
                lacks.append(np.setdiff1d(p, s, assume_unique=True).tobytes())
                adds.append(np.setdiff1d(s, p, assume_unique=True).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), part.column("pivot"), pa.array(base, pa.int64()),
                 pa.array(lacks, pa.binary()), pa.array(adds, pa.binary())],
                names=["rep", "pivot", "base", "lacks", "adds"])

    return pairs.join(own, "rep").join(other, "pivot").mapInArrow(
        differ, "rep long, pivot long, base long, lacks binary, adds binary")


def _common(values: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs, left by right, of short lists of hashes."""
    owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[number] > 1                      # hashes that only one document has don't count
    owner, number = owner[shared], number[shared]
    names, number = np.unique(number, return_inverse=True)
    out = np.zeros((len(left), len(right)))
    for at in range(0, len(names), 4096):
        here = (number >= at) & (number < at + 4096)
        x = np.zeros((len(values), min(4096, len(names) - at)), np.float32)
        x[owner[here], number[here] - at] = 1
        out += x[left] @ x[right].T
    lengths = np.array([len(v) for v in values])
    itself = left[:, None] == right[None, :]
    return np.where(itself, lengths[left][:, None], out.astype(np.int64))


def exact_links(rows: DataFrame, docs: DataFrame, reps: DataFrame, at: Threshold) -> DataFrame:
    """Spanning links (a, b) between components, exactly, among rows (node, rep, component)."""
    percent = at.percent
    groups = rows.groupBy("node").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).join(
        _largest_part(rows).drop("_parts"), "node")
    rows = materialize(rows.join(groups, "node"), "second-rows")
    asked = materialize(rows.select("rep", "pivot").distinct(), "second-pairs")
    diffs = materialize(differences(asked, full_sets(asked, docs, reps)), "differences")
    order = ["node", "_i", "_j"]
    cells = with_cells(rows.join(diffs, ["rep", "pivot"]), F.col("size"), F.col("rep"), SMALL,
                       F.col("component") == F.col("_main"), F.col("_n_main"))
    cells = (cells.select(*order, "_b", "rep", "component", "base", "lacks", "adds")
             .repartition(*order).sortWithinPartitions(*order))

    def link(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(parts, order):
            i, j = cell.column("_i")[0].as_py(), cell.column("_j")[0].as_py()
            rep, comp = cell.column("rep").to_numpy(), cell.column("component").to_numpy()
            b, base = cell.column("_b").to_numpy(), cell.column("base").to_numpy()
            lacks, adds = ([np.frombuffer(v, np.uint64) for v in cell.column(c).to_pylist()]
                           for c in ("lacks", "adds"))
            left, right = np.flatnonzero(b == i), np.flatnonzero(b == j)
            n_lacks = np.array([len(v) for v in lacks])
            size = base - n_lacks + np.array([len(v) for v in adds])
            # What both keep of the pivot's set, and what both add to it.
            kept = (base[left][:, None] - n_lacks[left][:, None] - n_lacks[right][None, :]
                    + _common(lacks, left, right))
            common = kept + _common(adds, left, right)
            union = size[left][:, None] + size[right][None, :] - common
            x, y = np.nonzero((100 * common >= percent * union)
                              & (comp[left][:, None] != comp[right][None, :]))
            if len(x):
                child, root = forest(rep[left[x]], rep[right[y]])
                yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(child)],
                                                 names=["a", "b"])

    return materialize(cells.mapInArrow(link, "a long, b long").distinct(), "second-links")


def _among(rows: DataFrame, column: str, ids: DataFrame, n: int) -> DataFrame:
    """Rows whose column is among ``n`` distinct ids."""
    side = ids.select(F.col(ids.columns[0]).alias("_id"))
    side = F.broadcast(side) if n <= BROADCAST_IDS else side
    return rows.join(side, F.col(column) == F.col("_id"), "left_semi")


def full_sets(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, set): the full shingle sets of the nodes in the two columns of ``pairs``."""
    x, y = pairs.columns
    ids = pairs.select(F.explode(F.array(x, y)).alias("rep")).distinct()
    asked = materialize(reps.select("rep", "key", F.col("doc").alias("_doc")).join(
        ids, "rep", "left_semi"), "asked")
    n = asked.count()

    def full(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [shingles(t.as_py()) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([_key(s) if len(s) else None for s in found],
                                          pa.binary()),
                 pa.array([s.tobytes() for s in found], pa.binary())],
                names=["_doc", "key", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"),
                        F.col("text").cast("string").cast("binary").alias("_text"))
    # An id repeated with other texts is told apart by the key of its set.
    sets = _among(texts, "_doc", asked.select("_doc").distinct(), n).mapInArrow(
        full, "_doc long, key binary, set binary")
    return materialize(sets.join(
        F.broadcast(asked) if n <= BROADCAST_IDS else asked, ["_doc", "key"]).dropDuplicates(
        ["rep"]).select("rep", "set"), "sets")


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, at: Threshold) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    percent = at.percent
    sets = full_sets(pairs, docs, reps)
    first = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
    second = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))
    few = pairs.count() <= BROADCAST_IDS
    both = second.join(F.broadcast(pairs) if few else pairs, "b").join(first, "a")

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            good = []
            for x, y in zip(part.column("set_a"), part.column("set_b")):
                s, t = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                if min(len(s), len(t)) * 100 < percent * max(len(s), len(t)):
                    good.append(False)
                    continue
                common = len(np.intersect1d(s, t, assume_unique=True))
                good.append(100 * common >= percent * (len(s) + len(t) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])

    return materialize(both.mapInArrow(check, "a long, b long"), "verified")


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and the key of its set."""
    at = Threshold(percent)
    described = materialize(describe(docs), "shingles")
    nodes = described.filter("key is not null and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("doc"), F.first("tokens").alias("tokens"))
    # Numbers, which the written table holds fast, name nodes whatever their documents' ids.
    reps = materialize(nodes.withColumn("rep", F.monotonically_increasing_id()), "sets-of-copies")

    def small(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            tokens = [np.frombuffer(t, np.uint32).astype(np.uint8).tobytes()
                      for t in part.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), pa.array(tokens, pa.binary())], names=["rep", "sketch"])

    leaves = materialize(chosen_paths(reps, at), "leaves")
    sketches = materialize(reps.select("rep", "tokens").join(
        leaves.select("rep").distinct(), "rep", "left_semi").mapInArrow(
        small, "rep long, sketch binary"), "sketches")
    found = verified(materialize(partners(leaves, sketches, at), "partners"), docs, reps, at)
    component = connected_components(found)
    more = materialize(remaining(leaves, sketches, component, at), "remaining")
    if not is_empty(more):
        component = connected_components(found.unionByName(exact_links(more, docs, reps, at)))
    # A component is represented by its smallest doc_id, and of that by its smallest key.
    linked = reps.select("rep", "key", "doc").join(
        component.withColumnRenamed("vertex", "rep"), "rep")
    first = linked.groupBy("component").agg(F.min(F.struct("doc", "key")).alias("_first"))
    named = linked.join(first, "component").select("rep", "_first")
    named = reps.select("rep", "key", "doc").join(named, "rep", "left").select(
        "key", F.coalesce("_first.doc", "doc").alias("_component"),
        F.coalesce(F.col("_first.key") == F.col("key"), F.lit(True)).alias("_leads"))
    out = described.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    kept = (F.col("doc_id") == component_id) & F.coalesce("_leads", F.lit(True))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"),
                      F.coalesce(kept, F.lit(True)).alias("kept"), "key")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; documents are linked from a
    similarity of ``percent`` per cent."""
    return _grouped(docs, percent).drop("key")


def op6_minhash_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, one of each group of near-duplicates, with the columns of ``docs``.  Rows
    without an id are held against each other only."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    some = _one_of_each(rows.filter("doc_id is not null"), percent)
    none = rows.filter("doc_id is null")
    if not is_empty(none):
        none = materialize(none.withColumn("doc_id", F.monotonically_increasing_id()), "no-ids")
        some = some.unionByName(_one_of_each(none, percent))
    return some.select("_row.*")


def _one_of_each(rows: DataFrame, percent: int) -> DataFrame:
    """(_row) of rows (_row, doc_id, text): of each component its first document, once."""
    grouped = materialize(_grouped(rows.select("doc_id", "text"), percent).select(
        F.col("doc_id").alias("_kept"), F.coalesce("key", F.lit(b"")).alias("_key"), "kept"),
        "grouped")
    repeated = materialize(rows.groupBy(F.col("doc_id").alias("_again")).agg(
        F.count("*").alias("_c")).filter("_c > 1").select("_again"), "repeated-ids")
    # The ids that go are few beside those that stay: while they fit a broadcast, no text is moved.
    gone = materialize(grouped.groupBy(F.col("_kept").alias("_gone")).agg(
        F.max("kept").alias("_stays")).filter("not _stays").select("_gone"), "gone")
    few = gone.count() <= BROADCAST_IDS
    rows = rows.join(F.broadcast(gone) if few else gone, F.col("doc_id") == F.col("_gone"),
                     "left_anti")
    if is_empty(repeated):
        return rows.select("_row")
    once = rows.join(repeated, F.col("doc_id") == F.col("_again"), "left_anti")
    # Rows of a repeated id are told apart by the keys of their sets; one stays of each id and key.
    again = materialize(rows.join(repeated, F.col("doc_id") == F.col("_again"), "left_semi")
                        .withColumn("_n", F.monotonically_increasing_id()), "repeated-rows")
    keys = describe(again.select(F.col("_n").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_n"), F.coalesce("key", F.lit(b"")).alias("_key"))
    one = again.select("_n", F.col("doc_id").alias("_kept"), F.xxhash64("text").alias("_h")).join(
        keys, "_n").groupBy("_kept", "_key").agg(F.min(F.struct("_h", "_n"))["_n"].alias("_n"))
    kept = grouped.filter("kept").select("_kept", "_key").distinct()
    one = one.join(kept, ["_kept", "_key"], "left_semi").select("_n")
    return once.select("_row").unionByName(again.join(one, "_n", "left_semi").select("_row"))
