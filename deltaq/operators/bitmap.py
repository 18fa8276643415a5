"""A bitmap of hashed keys, broadcast to rows: tells which of them may find a partner in a join
before they are shuffled.  All that do are kept; of the others about one in ``FILTER_BITS``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter per key (one other row in so many passes by chance), and the keys up to which
#: it is made: 2**30 bits are 128 MB.
FILTER_BITS = 16
FILTER_KEYS = (1 << 30) // FILTER_BITS


def _place(key: str | Sequence[str], bits: int) -> Column:
    keys = [key] if isinstance(key, str) else key
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def key_bitmap(keys: DataFrame, key: str | Sequence[str], bits: int) -> DataFrame:
    """Rows (bucket, bitmap): the hashed keys as bits, 32,768 to a row.  The bits are 512 longs, so
    that a look-up reads one of them where it lies; of a binary value it would copy all."""
    place = keys.select(_place(key, bits).alias("_place"))
    built = place.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bytes"))

    def word(i: Column) -> Column:
        eight = F.substring("_bytes", i * 8 + 1, F.lit(8))
        return F.conv(F.hex(eight), 16, -10).cast("bigint")

    return built.select("_bucket", F.transform(
        F.sequence(F.lit(0), F.lit(511)), word).alias("_bits"))


def _looked_up(rows: DataFrame, key: str | Sequence[str], bitmap: DataFrame, bits: int, how: str,
               ) -> tuple[DataFrame, Column]:
    place = _place(key, bits)
    at = F.bitmap_bit_position(place)
    long = F.get("_bits", F.shiftright(at, 6).cast("int"))
    # The first of the eight bytes is the highest of the long.
    bit = (7 - F.shiftright(at, 3) % 8) * 8 + at % 8
    hit = F.call_function("getbit", long, bit.cast("int")) == 1
    return rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(place) == F.col("_bucket"), how), hit


def may_match(rows: DataFrame, key: str | Sequence[str], bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be in the bitmap (all that are, and few others), unshuffled."""
    found, hit = _looked_up(rows, key, bitmap, bits, "inner")
    return found.filter(hit).drop("_bucket", "_bits")


def cannot_match(rows: DataFrame, key: str | Sequence[str], bitmap: DataFrame, bits: int,
                 ) -> DataFrame:
    """The other rows: those whose key is not in the bitmap for certain."""
    found, hit = _looked_up(rows, key, bitmap, bits, "left")
    return found.filter(~F.coalesce(hit, F.lit(False))).drop("_bucket", "_bits")
