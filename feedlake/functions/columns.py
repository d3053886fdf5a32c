"""PRJ-* projections and FN-* scalar functions. All are lazy DataFrame -> DataFrame or Column builders."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    FractionalType,
    IntegralType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from feedlake.spec import BATCH_COLUMN, split_list

_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def check_batch_date(batch_date: str) -> str:
    """Batch dates are ISO strings, so the lexical max is the latest batch."""
    if not isinstance(batch_date, str) or not _DATE.match(batch_date):
        raise ValueError(f"batch date must be yyyy-MM-dd, got {batch_date!r}")
    return batch_date


def resolve_columns(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """Map configured names to the frame's column names, case-insensitively (keys are configured lower-case)."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for n in split_list(names) if isinstance(names, str) else [s.strip() for s in names]:
        if n in df.columns:
            out.append(n)
        elif n.lower() in by_lower:
            out.append(by_lower[n.lower()])
        else:
            raise ValueError(f"column {n!r} not in {df.columns}")
    return out


def with_batchdate(df: DataFrame, batch_date: str) -> DataFrame:
    """PRJ-1: all columns plus the literal batch date as the last column (replaced in place if present)."""
    return df.withColumn(BATCH_COLUMN, F.lit(check_batch_date(batch_date)))


def drop_batchdate(df: DataFrame) -> DataFrame:
    """PRJ-2."""
    return df.drop(BATCH_COLUMN)


def drop_columns(df: DataFrame, names: str | Iterable[str]) -> DataFrame:
    """PRJ-3: drop a configured list; empty list and unknown names are no-ops."""
    cols = split_list(names) if isinstance(names, str) else [n for n in names if n]
    return df.drop(*cols) if cols else df


def rename_columns(df: DataFrame, mapping: Mapping[str, str] | None) -> DataFrame:
    """PRJ-4: rename by mapping; names missing from the frame are ignored."""
    if not mapping:
        return df
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def prefix_nonkey(df: DataFrame, keys: str | Iterable[str], prefix: str) -> DataFrame:
    """PRJ-5: prefix every non-key column, keep keys as they are."""
    key_cols = set(resolve_columns(df, keys))
    return df.select(*[F.col(c) if c in key_cols else F.col(c).alias(prefix + c) for c in df.columns])


def keys_with_label(df: DataFrame, keys: str | Iterable[str], label: str | Column) -> DataFrame:
    """PRJ-6: key columns plus a label column named column_name."""
    lab = label if isinstance(label, Column) else F.lit(label)
    return df.select(*resolve_columns(df, keys), lab.alias("column_name"))


# A string try_cast can only succeed for these shapes (whitespace is trimmed by the cast). Strings that
# cannot match are null without entering the cast, whose failure path costs ~20x a successful cast.
# the cast trims ASCII control characters as well as spaces
_INTEGRAL_SHAPE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"
_NUMBER_SHAPE = r"(?i)\p{Nd}|nan|inf"


def try_cast(c: Column, source: DataType, target: DataType) -> Column:
    """try_cast with a cheap shape test in front of string -> number casts; same results as try_cast."""
    if isinstance(source, StringType) and isinstance(target, IntegralType):
        return F.when(c.rlike(_INTEGRAL_SHAPE), c.try_cast(target))
    if isinstance(source, StringType) and isinstance(target, (FractionalType, DecimalType)):
        return F.when(c.rlike(_NUMBER_SHAPE), c.try_cast(target))
    return c.try_cast(target)


def cast_to_schema(df: DataFrame, schema: StructType | str) -> DataFrame:
    """PRJ-7: select the target's columns by name, each cast to its declared type (null when uncastable)."""
    target = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols = resolve_columns(df, [f.name for f in target.fields])
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[try_cast(F.col(c), types[c], f.dataType).alias(f.name) for c, f in zip(cols, target.fields)]
    )


def fill_empty_strings(df: DataFrame) -> DataFrame:
    """FN-4: nulls in string columns become ''; other types untouched."""
    return df.fillna("")


def mismatch_flag(left: Column, right: Column, name: str) -> Column:
    """FN-1: the column name when the two values differ, else ''. A null on either side is not flagged."""
    return F.when(left != right, F.lit(name)).otherwise(F.lit(""))


def mismatch_array(flags: list[Column]) -> Column:
    """FN-2: array of the flags with the empty ones removed."""
    return F.array_remove(F.array(*flags), "")


def array_to_string(c: Column) -> Column:
    """FN-3: Spark's array-to-string cast: '[a, b]', '[]' when empty."""
    return c.cast("string")


def has_map(dtype: DataType) -> bool:
    """Whether a type is or holds a map (or a variant), which Spark neither orders nor hashes."""
    if isinstance(dtype, (MapType, VariantType)):
        return True
    if isinstance(dtype, ArrayType):
        return has_map(dtype.elementType)
    return isinstance(dtype, StructType) and any(has_map(f.dataType) for f in dtype.fields)


def ddl_type(type_name: str) -> DataType:
    """Parse a catalog type string (e.g. 'bigint', 'decimal(10,2)') into a Spark type."""
    return StructType.fromDDL(f"x {type_name}").fields[0].dataType
