"""Key-wise comparison of difference rows with the stored batch (JN-2, JN-3, PIP-7, PIP-8).

The reference pairs every raw row with every difference row of the same key (an inner join), so a
duplicated key would emit all pairs of its group. Here the raw side is first reduced to one *profile* row
per key that occurs in the difference:

    raw  --left_semi(diff keys)-->  group by key: min(c), max(c) per column, row count

A column is flagged when some raw row of the key holds a non-null value different from the difference
row's non-null value, i.e. when min or max differs from it. With unique keys (the contract of a primary key)
this is exactly the reference's per-pair flag; with duplicated raw keys the flags of all raw rows of the key
are united in one row per difference row instead of one row per pair. Sizes stay linear:

- the semi-join reads only the difference's keys; AQE broadcasts them when measured small, so the raw
  batch is filtered in one map-only scan;
- the per-key aggregate combines map-side, so a key holding a third of the rows collapses before the shuffle;
- the profile is unique per key, so the final join emits at most one row per difference row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from feedlake.functions.columns import array_to_string, mismatch_array, resolve_columns
from feedlake.operators.setops import unused_name
from feedlake.spec import NEW_RECORD_LABEL

_RAW = "df_raw_"
_DIFF = "df_diff_"
_HIT = "df_raw__rows"


def _has_map(dtype: DataType) -> bool:
    if isinstance(dtype, MapType):
        return True
    if isinstance(dtype, ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def _orderable(c: Column, dtype: DataType) -> Column:
    """A value with an ordering for min/max: maps have none in Spark, their sorted entries do; nested maps
    and variants compare by their JSON text."""
    if isinstance(dtype, MapType) and not _has_map(dtype.keyType) and not _has_map(dtype.valueType):
        return F.array_sort(F.map_entries(c))
    if _has_map(dtype):
        return F.to_json(c)
    if isinstance(dtype, VariantType):
        return c.cast("string")
    return c


def key_profile(
    raw: DataFrame, diff: DataFrame, keys: list[str], columns: list[str], null_counts: bool = False
) -> DataFrame:
    """One row per key present in both: keys, df_raw_<c>_min, df_raw_<c>_max per column, df_raw__rows
    (and df_raw_<c>_nulls with null_counts)."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    candidates = raw.join(diff.select(*keys).distinct(), keys, "left_semi")
    aggs = []
    for c in columns:
        v = _orderable(F.col(c), types[c])
        aggs += [F.min(v).alias(f"{_RAW}{c}_min"), F.max(v).alias(f"{_RAW}{c}_max")]
        if null_counts:
            aggs.append(F.count(F.when(F.col(c).isNull(), 1)).alias(f"{_RAW}{c}_nulls"))
    aggs.append(F.count(F.lit(1)).alias(_HIT))
    return candidates.groupBy(*keys).agg(*aggs)


def _compare_columns(raw: DataFrame, diff: DataFrame, keys: list[str]) -> list[str]:
    raw_cols = set(raw.columns)
    return [c for c in diff.columns if c not in keys and c in raw_cols]


def pair_on_keys(raw: DataFrame, diff: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """JN-2: each difference row that has its key in raw, next to the raw profile of that key.

    Columns: keys, df_diff_<c>, df_raw_<c>_min, df_raw_<c>_max for every compared column, df_raw__rows.
    """
    key_cols = resolve_columns(diff, keys)
    cols = _compare_columns(raw, diff, key_cols)
    prof = key_profile(raw, diff, key_cols, cols)
    d = diff.select(*key_cols, *[F.col(c).alias(_DIFF + c) for c in cols])
    return d.join(prof, key_cols, "inner")


def mismatch_flags(diff_types: dict[str, DataType], cols: list[str], null_safe: bool = False) -> list[Column]:
    """FN-1 over `pair_on_keys`: per column its name where some raw row of the key holds another value, else ''."""
    out = []
    for c in cols:
        v = _orderable(F.col(_DIFF + c), diff_types[c])
        lo, hi = F.col(f"{_RAW}{c}_min"), F.col(f"{_RAW}{c}_max")
        differs = (lo != v) | (hi != v)
        if null_safe:
            # IS DISTINCT FROM some raw row: a null difference value against any non-null raw value, or a
            # non-null one against a differing or a null raw value
            nulls = F.col(f"{_RAW}{c}_nulls")
            differs = F.when(v.isNull(), lo.isNotNull()).otherwise(F.coalesce(differs, F.lit(False)) | (nulls > 0))
        out.append(F.when(differs, F.lit(c)).otherwise(F.lit("")))
    return out


def mismatch_report(
    raw: DataFrame, diff: DataFrame, keys: str | Iterable[str], null_safe: bool = False
) -> DataFrame:
    """PIP-7 + PIP-8 + SET-2 in one join: keys, column_name.

    column_name is the string form of the list of differing columns ('[a, b]', '[]' when only nulls
    changed) for difference rows whose key exists in raw, and 'new record' for the others. Null key
    parts never match, so such rows are always new records. With null_safe a change to or from null is
    flagged too.
    """
    key_cols = resolve_columns(diff, keys)
    cols = _compare_columns(raw, diff, key_cols)
    types = {f.name: f.dataType for f in diff.schema.fields}
    prof = key_profile(raw, diff, key_cols, cols, null_counts=null_safe)
    d = diff.select(*key_cols, *[F.col(c).alias(_DIFF + c) for c in cols])
    joined = d.join(prof, key_cols, "left")
    label = F.when(F.col(_HIT).isNull(), F.lit(NEW_RECORD_LABEL)).otherwise(
        array_to_string(mismatch_array(mismatch_flags(types, cols, null_safe)))
    )
    return joined.select(*key_cols, label.alias("column_name"))


def recon_mismatch(raw: DataFrame, diff: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """PIP-7: keys, column_name for difference rows whose key exists in raw."""
    key_cols = resolve_columns(diff, keys)
    cols = _compare_columns(raw, diff, key_cols)
    types = {f.name: f.dataType for f in diff.schema.fields}
    paired = pair_on_keys(raw, diff, key_cols)
    return paired.select(*key_cols, array_to_string(mismatch_array(mismatch_flags(types, cols))).alias("column_name"))


def anti_join_keys(left: DataFrame, right: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """JN-3: rows of `left` whose key is absent from `right` (only right's keys are read)."""
    key_cols = resolve_columns(left, keys)
    rk = right.select(*resolve_columns(right, key_cols)).toDF(*key_cols).distinct()
    return left.join(rk, key_cols, "left_anti")


def recon_new_records(diff: DataFrame, raw: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """PIP-8: keys of difference rows unknown to raw, labelled 'new record'.

    A key is in the mismatch report exactly when it is in raw, so the anti-join runs against raw's keys.
    """
    key_cols = resolve_columns(diff, keys)
    return anti_join_keys(diff, raw, key_cols).select(*key_cols, F.lit(NEW_RECORD_LABEL).alias("column_name"))


def keyed_difference_report(
    source: DataFrame, raw: DataFrame, keys: str | Iterable[str], null_safe: bool = False, repeated: bool = False
) -> DataFrame:
    """Difference and column report from one keyed join, for keys unique in raw.

    source LEFT JOIN raw on the keys (null-safe, so rows with null key parts pair up like EXCEPT compares
    them). A source row is a difference row unless an identical raw row exists; its column_name is the
    list of differing columns, or 'new record' when no raw row has its key (a null key part never matches,
    as in the reference). Output: the source columns plus column_name, difference rows only.

    Equal to difference() + mismatch_report() when the keys are unique in both inputs (the schema gate's
    duplicate_key check); then one shuffle on the key replaces the whole-row EXCEPT shuffle and the
    profile join, and AQE broadcasts either side when it is small. With `repeated` the source's keys may repeat:
    rows of one key are compared with its raw row one by one, and equal difference rows are one, as in EXCEPT DISTINCT
    (one more shuffle, of the difference rows alone).
    """
    key_cols = resolve_columns(source, keys)
    cols = [c for c in source.columns if c not in key_cols and c in set(raw.columns)]
    r = raw.select(*[F.col(k).alias(_RAW + k) for k in key_cols], *[F.col(c).alias(_RAW + c) for c in cols],
                   F.lit(True).alias(_HIT))
    cond = [source[k].eqNullSafe(r[_RAW + k]) for k in key_cols]
    j = source.join(r, cond, "left")
    same_row = F.col(_HIT).isNotNull()
    for c in cols:
        same_row = same_row & source[c].eqNullSafe(F.col(_RAW + c))
    for c in source.columns:
        if c not in key_cols and c not in cols:  # source columns raw lacks: the row cannot be in raw
            same_row = F.lit(False)
    key_match = F.col(_HIT).isNotNull()
    for k in key_cols:
        key_match = key_match & source[k].isNotNull()
    if null_safe:
        flags = [F.when(~source[c].eqNullSafe(F.col(_RAW + c)), F.lit(c)).otherwise(F.lit("")) for c in cols]
    else:
        flags = [F.when(source[c] != F.col(_RAW + c), F.lit(c)).otherwise(F.lit("")) for c in cols]
    label = F.when(key_match, array_to_string(mismatch_array(flags))).otherwise(F.lit(NEW_RECORD_LABEL))
    out = j.where(~same_row).select(*[source[c] for c in source.columns], label.alias("column_name"))
    if not repeated:
        return out
    # grouped, as distinct() takes no maps; equal source rows have one raw row, so one label
    n = unused_name("n", out)
    return out.groupBy(*[F.col("`" + c.replace("`", "``") + "`") for c in out.columns]).agg(F.count(F.lit(1)).alias(n)).drop(n)


def has_duplicate_keys(df: DataFrame, keys: str | Iterable[str]) -> bool:
    """Whether any key occurs twice: a key-only grouped count (combined map-side), stopping at the first hit."""
    key_cols = resolve_columns(df, keys)
    return df.groupBy(*key_cols).count().where(F.col("count") > 1).limit(1).count() > 0
