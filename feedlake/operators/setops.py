"""Set operations (SET-1/2), and the difference of two large frames that are nearly alike."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from feedlake.functions.columns import resolve_columns
from feedlake.workspace import materialize


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """SET-1: EXCEPT DISTINCT by position: distinct rows of `left` absent from `right`; nulls compare equal.

    Both sides are tagged, put together and grouped by all columns; groups with a row of `right` go. One shuffle on the
    whole row and no join, and a row repeated any number of times, on either side, is one row a task before it.
    """
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} and {len(right.columns)} columns")
    tag = unused_name("in_right", left, right)
    both = left.withColumn(tag, F.lit(0)).union(right.withColumn(tag, F.lit(1)))
    rows = [F.col("`" + c.replace("`", "``") + "`") for c in left.columns]
    return both.groupBy(*rows).agg(F.max(tag).alias(tag)).where(F.col(tag) == 0).drop(tag)


def unused_name(name: str, *frames: DataFrame) -> str:
    taken = {c.lower() for f in frames for c in f.columns}
    while name in taken:
        name += "_"
    return name


def _hashable(c: Column, dtype: DataType) -> list[Column]:
    """What a row hash takes of a value: Spark's hashes pass over nulls, so each null is told apart, in nested values too."""
    if isinstance(dtype, (ArrayType, MapType, StructType, VariantType)):
        c = F.to_json(c, {"ignoreNullFields": "false"}) if not isinstance(dtype, VariantType) else c.cast("string")
    return [c, c.isNull()]


def bucket_digests(df: DataFrame, keys: Iterable[str], buckets: int) -> DataFrame:
    """(bucket, n, a, b, c, d): for each bucket of the key hash its row count and the sums of the four 32-bit halves of two
    64-bit row hashes. The order of rows does not matter and repeats count. Combined map-side: a task sends at most
    `buckets` short rows."""
    parts = [p for f in df.schema.fields for p in _hashable(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType)]
    hashed = df.select(bucket_number(df, keys, buckets).alias("bucket"), F.xxhash64(*parts).alias("x"),
                       F.xxhash64(F.lit("second"), *reversed(parts)).alias("y"))
    low, high = lambda h: F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), lambda h: F.shiftrightunsigned(h, 32)
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(low("x")).alias("a"), F.sum(high("x")).alias("b"),
        F.sum(low("y")).alias("c"), F.sum(high("y")).alias("d"),
    )


def bucket_number(df: DataFrame, keys: Iterable[str], buckets: int) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [p for k in keys for p in _hashable(F.col("`" + k.replace("`", "``") + "`"), types[k])]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def pruned_difference(left: DataFrame, right: DataFrame, keys: str | Iterable[str], buckets: int = 1 << 16) -> DataFrame:
    """SET-1 for sides that hardly differ: the rows of `difference`, of which only unlike buckets are shuffled.

    Both sides are reduced to digests by key bucket; buckets whose digests agree hold the same rows and are left out of
    the difference, map-side, by a broadcast of the unlike bucket numbers (at most `buckets` integers). Each side is read
    twice and shuffled once, in the part that differs. Rows of a bucket that differ would pass as the same only if both
    64-bit hash sums met by chance: below 2**-64 a bucket, for hashes taken as random. Where that is not enough, or where
    most buckets differ, use `difference`, which compares every row. Sides are matched by position, and a value whose
    type differs between them makes its bucket unlike, never alike.
    """
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} and {len(right.columns)} columns")
    right = right.toDF(*left.columns)
    by = resolve_columns(left, keys)
    sums = ["n", "a", "b", "c", "d"]
    ours = bucket_digests(left, by, buckets)
    theirs = bucket_digests(right, by, buckets).toDF("other", *[f"their_{c}" for c in sums])
    same = [F.col(c).eqNullSafe(F.col(f"their_{c}")) for c in sums]
    unlike = ours.join(theirs, ours["bucket"] == theirs["other"], "left").where(~_all(same)).select("bucket")
    unlike = materialize(unlike, "unlike-buckets")
    at = unused_name("bucket", left)
    parts = [side.withColumn(at, bucket_number(side, by, buckets)).join(F.broadcast(unlike.toDF(at)), at, "left_semi").drop(at) for side in (left, right)]
    return difference(*parts)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def concat(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-2: positional UNION ALL."""
    return a.union(b)
