"""Prefilters by a bitmap of hashes, a Bloom filter with one hash function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits for each key that is looked for, and the most in all: 64 MB, so the bitmap can be
# broadcast. Beyond that more rows pass that need not; none that must is held back.
BITS_EACH = 16
MOST_BITS = 1 << 29
_BUCKET = 1 << 15


def _bits(count: int, most: int) -> int:
    bits = _BUCKET
    while bits < min(most, count * BITS_EACH):
        bits *= 2
    return bits


def may_be_among(
    rows: DataFrame, wanted: DataFrame, key: str, most_bits: int = MOST_BITS
) -> DataFrame:
    """The rows whose `key` may be one of `wanted`, and nearly none of the others.

    The rows stay where they are and as they are partitioned. `wanted` is read
    twice, for the size of the bitmap and for the bitmap.
    """
    bits = _bits(wanted.count(), most_bits)

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1

    at = place(F.col(f"`{key}`"))
    bitmap = wanted.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")
    )
    spot = F.bitmap_bit_position(at)
    byte = F.substr("_bits", F.shiftright(spot, 3).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.getbit(value, (spot % 8).cast("int")) == 1
    # At most `most_bits` in all.
    held = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(at) == F.col("_bucket"))
    return held.filter(is_set).drop("_bucket", "_bits")
