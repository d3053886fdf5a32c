"""Snapshot operators: latest batch, carried-forward rows, snapshot date (FLT-2/3, JN-1, AGG-4/5, PIP-1/2).

Scale notes
- `latest_batch` filters on an uncorrelated scalar subquery over the partition column; on a table
  partitioned by `batchdate` the subquery reads no column data and the filter prunes partitions at run time.
- `unchanged_records` is a left-anti equi-join on the key list against the delta's keys only. Nothing is
  hinted: AQE broadcasts the delta keys when their measured size is below the broadcast threshold (the
  usual daily case: the history side is then scanned once, map-only, with no shuffle) and otherwise
  shuffles both sides, splitting hot keys of the history side (AQE skew join supports left-anti).
- Null key parts never match, so such rows are always carried forward (reference behaviour).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.columns import check_batch_date, resolve_columns, with_batchdate
from feedlake.operators.keyfilter import split_by_keys
from feedlake.spec import BATCH_COLUMN, DEFAULT_SNAPSHOT_DATE


def where_batch(df: DataFrame, batch_date: str) -> DataFrame:
    """FLT-1: rows of one batch; a literal on the partition column prunes partitions statically."""
    return df.where(F.col(BATCH_COLUMN) == F.lit(check_batch_date(batch_date)))


def latest_batch(history: DataFrame, before: str | None = None, latest: str | None = None) -> DataFrame:
    """FLT-2: rows whose batchdate equals the max batchdate (optionally the max below `before`).

    `before` makes a rerun of a batch carry rows from the previous snapshot instead of its own.
    An empty history gives no rows. When the caller already knows the latest batch (from catalog
    partition metadata, `sources.latest_partition`), `latest` turns the filter into a literal, so the
    partition is pruned while planning and no file footer is read to find it.
    """
    if latest is not None:
        return history.where(F.col(BATCH_COLUMN) == F.lit(check_batch_date(latest)))
    h = history if before is None else history.where(F.col(BATCH_COLUMN) < F.lit(check_batch_date(before)))
    latest = h.select(F.max(BATCH_COLUMN))
    return h.where(F.col(BATCH_COLUMN) == latest.scalar())


def unmatched_rows(
    left: DataFrame, right: DataFrame, keys: str | Iterable[str], bucketed: bool = False, filter_bits: int | None = None
) -> DataFrame:
    """FLT-3/JN-1 core: rows of `left` whose composite key has no equal key in `right`.

    Same rows as the reference's outer join filtered on a null right key, written as the anti-join Catalyst
    does not derive by itself. Only the key columns of `right` are read, de-duplicated with a map-side
    partial aggregate first, so a key repeated in a third of the delta crosses the network once per task;
    the aggregate's hash partitioning is the one the shuffle join needs, so no exchange is added.

    `bucketed`: left is read bucket by bucket, where no exchange lets AQE split a hot bucket. Rows with a null key part,
    which all lie in one bucket, never match: they go past the join in a scan of their own, split by file size.

    `filter_bits`: only rows of `left` that may have a match, by a broadcast bitmap of so many bits of right's keys
    (`keyfilter.split_by_keys`), meet the exact join; the rest go past it and its shuffle. No verdict depends on the hash. It
    pays for a delta too large to broadcast and small against `left`: `left` is scanned twice, and its shuffle falls to the
    share that matches and one row in (bits / keys). Take some 16 bits a key; far too few cost a scan and save nothing. Not
    used on bucketed sides, whose join does not shuffle `left`, nor where the key's types do not allow it.
    """
    key_cols = resolve_columns(left, keys)
    if filter_bits is not None and not bucketed:
        halves = split_by_keys(left, right, key_cols, resolve_columns(right, key_cols), filter_bits)
        if halves is not None:
            maybe, past = halves
            return unmatched_rows(maybe, right, key_cols).select(past.columns).union(past)
    right_keys = right.select(*[F.col(c) for c in resolve_columns(right, key_cols)]).toDF(*key_cols).distinct()
    if not bucketed:
        return left.join(right_keys, key_cols, "left_anti")
    no_key = reduce(or_, [left[c].isNull() for c in key_cols])
    return left.where(~no_key).join(right_keys, key_cols, "left_anti").unionByName(left.where(no_key))


def unchanged_records(
    history: DataFrame,
    delta: DataFrame,
    keys: str | Iterable[str],
    before: str | None = None,
    latest: str | None = None,
    bucketed: bool = False,
    filter_bits: int | None = None,
) -> DataFrame:
    """JN-1: rows of the latest history batch whose key is not in the delta; they keep their batchdate."""
    return unmatched_rows(latest_batch(history, before, latest), delta, keys, bucketed, filter_bits)


def count_unchanged(
    history: DataFrame, delta: DataFrame, keys: str | Iterable[str], before: str | None = None
) -> DataFrame:
    """AGG-4: one row, unchangedcnt."""
    return unchanged_records(history, delta, keys, before).agg(F.count(F.lit(1)).alias("unchangedcnt"))


def snapshot_date(df: DataFrame, default: str = DEFAULT_SNAPSHOT_DATE) -> DataFrame:
    """AGG-5: one row, the max batchdate or the default when there is none."""
    return df.agg(F.coalesce(F.max(BATCH_COLUMN), F.lit(default)).alias("snapshot_date"))


def incremental_snapshot(
    delta: DataFrame,
    history: DataFrame,
    keys: str | Iterable[str],
    batch_date: str,
    before: str | None = None,
    latest: str | None = None,
    bucketed: bool = False,
    filter_bits: int | None = None,
) -> DataFrame:
    """PIP-1: the delta stamped with batch_date, plus the carried-forward rows of the latest history batch.

    One plan: union of the stamped delta and the anti-join. No de-duplication and no deletes.
    """
    stamped = with_batchdate(delta, batch_date)
    carried = unchanged_records(history, delta, keys, before, latest, bucketed, filter_bits)
    return stamped.unionByName(carried.select(*stamped.columns))


def full_refresh(delta: DataFrame, batch_date: str) -> DataFrame:
    """PIP-2: without incremental load the raw image is the delta alone."""
    return with_batchdate(delta, batch_date)
