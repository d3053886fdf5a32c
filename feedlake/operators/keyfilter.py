"""Anti-join behind a bitmap of the other side's keys (JN-1 for deltas too large to broadcast)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, DecimalType, IntegralType, StringType, TimestampNTZType, TimestampType

from feedlake.operators.setops import unused_name

#: Fixed value: bits in one value of Spark's bitmap aggregate (4,096 bytes).
BITMAP_BITS = 1 << 15
#: Bits of the whole filter: 2 MB, about 16 bits a key for a million delta keys.
DEFAULT_BITS = 1 << 24

_EXACT = (IntegralType, BooleanType, DateType, TimestampType, TimestampNTZType, DecimalType, BinaryType)


def key_bit(key_columns: Iterable[Column], bits: int) -> Column:
    """The bit of a key among `bits`, from its 64-bit hash."""
    return F.pmod(F.xxhash64(*key_columns), F.lit(bits))


def key_bitmap(right: DataFrame, key_columns: list[str], bits: int = DEFAULT_BITS) -> DataFrame:
    """(part, words): the bits of the frame's keys, `BITMAP_BITS` of them a row as 1,024 integers; parts without a key are
    left out. Combined map-side, so a repeated key costs nothing and a task sends at most `bits` / 8 bytes."""
    bit = key_bit([F.col(c) for c in key_columns], bits)
    parts = right.select(F.shiftright(bit, 15).cast("int").alias("part"), bit.bitwiseAND(F.lit(BITMAP_BITS - 1)).alias("at"))
    maps = parts.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bytes"))
    # unpacked once a part: a probe then reads one integer in place instead of copying 4,096 bytes
    word = lambda i: F.conv(F.hex(F.substring("bytes", i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    signed = lambda w: F.when(w >= 1 << 31, w - (1 << 32)).otherwise(w).cast("int")
    return maps.select("part", F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // 32 - 1)), lambda i: signed(word(i))).alias("words"))


def _same_hash(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> bool:
    """Whether equal keys surely have equal hashes: each key column has one type on both sides, compared bit by bit."""
    pairs = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in zip(left_keys, right_keys, strict=True)]
    return all(a == b and (isinstance(a, _EXACT) or a == StringType()) for a, b in pairs)


def split_by_keys(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], bits: int = DEFAULT_BITS) -> tuple[DataFrame, DataFrame] | None:
    """(rows of `left` that may have an equal key in `right`, rows that surely have none), by a bitmap of the keys.

    The bitmap of `bits` bits is broadcast: `bits` / 8 bytes, whatever the size of `right`. Rows with a null key part never
    match. None where a hash cannot decide: a key's types differ between the sides, or equal values may differ in bytes
    (floating point, collated or nested keys).
    """
    if bits < BITMAP_BITS or bits % BITMAP_BITS or bits > 1 << 40:
        raise ValueError(f"bits must be a multiple of {BITMAP_BITS}: {bits}")
    if not _same_hash(left, right, left_keys, right_keys):
        return None
    part, words = unused_name("key_part", left), unused_name("key_words", left)
    known = reduce(and_, [F.col(c).isNotNull() for c in right_keys])
    bitmap = F.broadcast(key_bitmap(right.where(known), right_keys, bits).toDF(part, words))
    bit = key_bit([F.col(c) for c in left_keys], bits)
    at = bit.bitwiseAND(F.lit(BITMAP_BITS - 1)).cast("int")
    # the first of a word's four bytes is its highest
    shift = (F.lit(3) - F.shiftright(at, 3) % 4) * 8 + at % 8
    probed = left.withColumn(part, F.shiftright(bit, 15).cast("int")).join(bitmap, part, "left")
    word = F.get(F.col(words), F.shiftright(at, 5))
    is_set = F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1)) == 1
    maybe = F.coalesce(is_set, F.lit(False)) & reduce(and_, [F.col(c).isNotNull() for c in left_keys])
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in left.columns]
    return probed.where(maybe).select(*columns), probed.where(~maybe).select(*columns)
