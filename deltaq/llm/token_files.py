"""Token-id files with a minimal perfect hash index from document keys to places in the shards.

File format, under one folder:

* ``payload/``  — Parquet, one row per document: ``shard`` int, ``row`` long (place in the shard),
  ``local_start`` long (ids before it in the shard), ``n_tokens`` long, ``ids`` binary
  (little-endian, 2 bytes an id where every id is below 65,536, else 4), and the document's key.
  Shards are ranges of ascending document keys, in order.
* ``shards/``   — ``shard``, ``base`` (ids in the shards before it), ``n_tokens``, ``n_docs``.
* ``index/``    — one row per bucket of about 1,000 keys: ``bucket``, ``n_keys``, ``seeds``
  (int32 per sub-bucket), ``prints`` (uint32 fingerprint per slot), ``places`` (shard, row,
  local_start, n_tokens as int64 per slot).
* ``meta/``     — number of buckets and bytes per id.

The index is a hash-and-displace minimal perfect hash: a key's bucket and sub-bucket give a seed,
the seed and the key give its slot, with exactly as many slots as keys.  Looking a key up costs a
few hashes; a fingerprint tells keys that were never stored (but for one in 2^32).

Edge cases: a null text is an empty one; a repeated key is stored as (key, occurrence 0, 1, ...),
its rows following each other; null keys come last and are found by key null; an empty table
writes empty tables; very long texts are encoded in segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaq.llm.common import batches, mix64
from deltaq.llm.encode import encoder, tokenizer_path
from deltaq.session import work_dir

BUCKET_KEYS = 1000       # keys per index bucket, on average
SUB_KEYS = 3             # keys per sub-bucket, on average
SEEDS_AT_ONCE = 64

PAYLOAD = ("doc_id long, occurrence long, shard int, row long, local_start long, n_tokens long, "
           "ids binary")
INDEX = "bucket long, n_keys int, seeds binary, prints binary, places binary"
PLACE = np.dtype([("shard", "<i8"), ("row", "<i8"), ("start", "<i8"), ("n", "<i8")])


@dataclass
class TokenFiles:
    """A written folder and how to read it."""

    spark: SparkSession
    path: str

    def read(self, part: str) -> DataFrame:
        schemas = {"payload": PAYLOAD, "index": INDEX, "meta": "buckets long, id_bytes int",
                   "shards": "shard int, base long, n_tokens long, n_docs long"}
        return self.spark.read.schema(schemas[part]).parquet(f"{self.path}/{part}")


# ---- writing -------------------------------------------------------------------------------

def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None,
                      end_id: int | None = 2) -> TokenFiles:
    """Encode every text, append ``end_id``, write shards in ascending key order and the index."""
    spark = docs.sparkSession
    file = tokenizer or tokenizer_path()
    width = 2 if max(_vocabulary(file), end_id or 0) < 1 << 16 else 4
    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange(F.col("doc_id").asc_nulls_last())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text"))

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        row = start = occurrence = 0
        last: object = ()
        for part in parts:
            keys = part.column(0).to_pylist()

            def rows(keys=keys, part=part):
                nonlocal row, start, occurrence, last
                ids_of = encoder(file).ids(part.column(1).to_pylist())
                for key, ids in zip(keys, ids_of):
                    if end_id is not None:
                        ids = np.append(ids, np.uint32(end_id))
                    occurrence = occurrence + 1 if key == last else 0
                    last = key
                    yield (key, occurrence, shard, row, start, len(ids),
                           ids.astype(f"<u{width}").tobytes())
                    row, start = row + 1, start + len(ids)

            yield from batches({"doc_id": pa.int64(), "occurrence": pa.int64(),
                                "shard": pa.int32(), "row": pa.int64(), "local_start": pa.int64(),
                                "n_tokens": pa.int64(), "ids": pa.binary()}, rows(), 512)

    (ordered.mapInArrow(encode, PAYLOAD).write.option("compression", "zstd")
     .parquet(f"{path}/payload"))
    files = TokenFiles(spark, path)
    payload = files.read("payload")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (payload.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"),
                                  F.count("*").alias("n_docs"))     # one row per shard
     .select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"),
             "n_tokens", "n_docs").write.parquet(f"{path}/shards"))
    buckets = max(1, payload.count() // BUCKET_KEYS)
    spark.range(1).select(F.lit(buckets).cast("long").alias("buckets"),
                          F.lit(width).alias("id_bytes")).write.parquet(f"{path}/meta")
    _index(payload, buckets).write.parquet(f"{path}/index")
    return files


def _vocabulary(file: str) -> int:
    return encoder(file).tokenizer.get_vocab_size(with_added_tokens=True)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(buckets)).cast("long")


def _index(payload: DataFrame, buckets: int) -> DataFrame:
    keys = payload.select("doc_id", "occurrence", "shard", "row", "local_start", "n_tokens",
                          _bucket(buckets).alias("bucket"))

    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"bucket": pa.int64(), "n_keys": pa.int32(), "seeds": pa.binary(),
                 "prints": pa.binary(), "places": pa.binary()}
        yield from batches(types, map(_build_bucket, _runs(parts)), 64)

    return (keys.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "occurrence")
            .mapInArrow(build, INDEX))


def _runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one bucket after another, from rows in bucket order."""
    held: list[pa.Table] = []
    for part in parts:
        rows = pa.Table.from_batches([part])
        ids = rows.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and held[0].column("bucket")[0].as_py() != ids[a]:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


def key_words(doc_id: pa.Array, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words that tell any two keys apart; null keys have a flag of their own."""
    null = doc_id.is_null().to_numpy(zero_copy_only=False)
    first = doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    second = occurrence.astype(np.uint64) | (null.astype(np.uint64) << np.uint64(63))
    return first, second


def key_hash(words: tuple[np.ndarray, np.ndarray], seed: np.ndarray | int) -> np.ndarray:
    golden = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        s = mix64((np.asarray(seed, np.uint64) + np.uint64(1)) * golden)
        return mix64(mix64(words[0] + s) + words[1] * golden)


def displace(words: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per sub-bucket (below 0: the slot itself, less one) and each key's slot."""
    n = len(words[0])
    subs = -(-n // SUB_KEYS)
    sub = (key_hash(words, 0) % np.uint64(subs)).astype(np.int64)
    order = np.argsort(sub, kind="stable")
    bounds = np.searchsorted(sub[order], np.arange(subs + 1))
    seeds = np.zeros(subs, np.int32)
    slots = np.full(n, -1, np.int64)
    free = np.ones(n, bool)
    for s in np.argsort(bounds[:-1] - bounds[1:], kind="stable"):       # the fullest first
        members = order[bounds[s]:bounds[s + 1]]
        if len(members) == 0:
            break
        if len(members) == 1:
            slot = int(np.argmax(free))
            seeds[s] = -1 - slot
            slots[members], free[slot] = slot, False
            continue
        own = (words[0][members, None], words[1][members, None])
        first = 1
        while True:
            tried = np.arange(first, first + SEEDS_AT_ONCE)
            at = (key_hash(own, tried[None, :]) % np.uint64(n)).astype(np.int64)
            fits = free[at].all(axis=0)
            if fits.any():
                ranked = np.sort(at[:, fits], axis=0)
                apart = np.flatnonzero((np.diff(ranked, axis=0) != 0).all(axis=0))
                if len(apart):
                    k = np.flatnonzero(fits)[apart[0]]
                    seeds[s] = tried[k]
                    slots[members] = at[:, k]
                    free[at[:, k]] = False
                    break
            first += SEEDS_AT_ONCE
    return seeds, slots


def slot_of(words: tuple[np.ndarray, np.ndarray], seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(key_hash(words, 0) % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    hashed = (key_hash(words, np.maximum(seed, 0)) % np.uint64(n)).astype(np.int64)
    return np.where(seed < 0, -1 - seed, hashed)


def fingerprints(words: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (key_hash(words, 1 << 40) >> np.uint64(32)).astype("<u4")


def _build_bucket(rows: pa.Table) -> tuple:
    words = key_words(rows.column("doc_id").combine_chunks(), rows.column("occurrence").to_numpy())
    seeds, slots = displace(words)
    prints = np.zeros(len(slots), "<u4")
    prints[slots] = fingerprints(words)
    places = np.zeros(len(slots), PLACE)
    for name, column in zip(PLACE.names, ("shard", "row", "local_start", "n_tokens")):
        places[name][slots] = rows.column(column).to_numpy()
    return (rows.column("bucket")[0].as_py(), len(slots), seeds.astype("<i4").tobytes(),
            prints.tobytes(), places.tobytes())


# ---- reading -------------------------------------------------------------------------------

def locate(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """Places of keys (columns doc_id, occurrence), by the index alone: one row per stored key.
    Keys go to their bucket's index row as one list, so index rows are read once."""
    buckets = files.read("meta").first()["buckets"]
    asked = (keys.select("doc_id", "occurrence", _bucket(buckets).alias("bucket")).distinct()
             .groupBy("bucket").agg(F.collect_list(F.struct("doc_id", "occurrence")).alias("keys")))
    joined = asked.join(files.read("index"), "bucket")

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = part.slice(i, 1)
                asked_keys = row.column("keys").flatten()
                doc_id, occurrence = asked_keys.flatten()
                words = key_words(doc_id, occurrence.to_numpy())
                seeds = np.frombuffer(row.column("seeds")[0].as_py(), "<i4")
                prints = np.frombuffer(row.column("prints")[0].as_py(), "<u4")
                places = np.frombuffer(row.column("places")[0].as_py(), PLACE)
                slots = slot_of(words, seeds, len(prints))
                known = prints[slots] == fingerprints(words)
                found = places[slots][known]
                keep = pa.array(known)
                yield pa.RecordBatch.from_arrays(
                    [doc_id.filter(keep), occurrence.filter(keep),
                     pa.array(found["shard"].astype(np.int32)), pa.array(found["row"]),
                     pa.array(found["start"]), pa.array(found["n"])],
                    names=["doc_id", "occurrence", "shard", "row", "local_start", "n_tokens"])

    return joined.mapInArrow(look, "doc_id long, occurrence long, shard int, row long, "
                                   "local_start long, n_tokens long")


def lookup(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """Raw ids (binary) of the given keys."""
    keys = keys if "occurrence" in keys.columns else keys.withColumn(
        "occurrence", F.lit(0).cast("long"))
    payload = files.read("payload").select("shard", "row", "ids")
    return locate(files, keys).join(payload, ["shard", "row"])


def checksums(files: TokenFiles) -> DataFrame:
    """(shard, row, n_ids, ids_crc32) of every stored payload, as little-endian 32-bit ids."""
    width = files.read("meta").first()["id_bytes"]

    def crc(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = [np.frombuffer(x, f"<u{width}").astype("<u4")
                   for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("shard"), part.column("row"),
                 pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())],
                names=["shard", "row", "n_ids", "ids_crc32"])

    return files.read("payload").select("shard", "row", "ids").mapInArrow(
        crc, "shard int, row long, n_ids long, ids_crc32 long")


def op9_token_files(docs: DataFrame) -> DataFrame:
    """Write the files, then look every key up in the index and read its ids back."""
    spark = docs.sparkSession
    files = write_token_files(docs, work_dir(spark, "token-files"))
    keys = files.read("payload").select("doc_id", "occurrence")
    shards = files.read("shards").select("shard", "base")
    read = locate(files, keys).join(checksums(files), ["shard", "row"])
    return read.join(F.broadcast(shards), "shard").select(    # one row per shard file
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"),
        F.col("n_ids").alias("n_tokens"), "ids_crc32")
