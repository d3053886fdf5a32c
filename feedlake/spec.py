"""Feed, reconciliation and request specifications (what changes results)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed values that must equal the reference's for equal results.
DEFAULT_SNAPSHOT_DATE = "2001-01-31"  # partition used when the raw table is empty
NEW_RECORD_LABEL = "new record"  # column_name of difference rows whose key is unknown to raw
DEFAULT_NUM_PARTITIONS = 30  # output files of a load whose settings name no number
BATCH_COLUMN = "batchdate"  # string partition column, ISO yyyy-MM-dd
# staged text lines that do not fit the feed's schema keep their text in this column
REJECTED = "rejected_line"
# the landing file a staged row came from
SOURCE_FILE = "source_file"
# columns that staging adds: the schema gate knows them and a load leaves them out
PROVENANCE = (SOURCE_FILE, REJECTED)


def split_list(value: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """Comma-separated configuration list -> list of stripped, non-empty names."""
    if value is None:
        return []
    items = value.split(",") if isinstance(value, str) else list(value)
    return [s.strip() for s in items if s and s.strip()]


@dataclass(frozen=True)
class FeedSpec:
    """One feed: the pre-raw (staged) table, the raw image, the history of snapshots."""

    pre_raw_table: str
    raw_table: str
    primary_key: tuple[str, ...]
    history_table: str | None = None
    incremental: bool = True
    # None keeps the natural split-sized output files; an int bounds the file count like the
    # reference's COALESCE hint (its default was 30, tuned for small feeds).
    num_partitions: int | None = None
    # Raw and history are bucketed by the primary key into so many buckets (sinks.create_feed_table); the daily
    # snapshot then shuffles only the delta. The load raises if raw is not bucketed so; None asks for nothing.
    buckets: int | None = None
    # Bits of the delta's key filter (operators.keyfilter), for deltas too large to broadcast against history without
    # buckets: history rows whose key is surely not in the delta pass no shuffle. Some 16 bits a delta key.
    key_filter_bits: int | None = None

    @staticmethod
    def keys(value: str | list[str]) -> tuple[str, ...]:
        return tuple(split_list(value))

    @classmethod
    def from_options(cls, options: Mapping[str, str], database: str | None = None, num_partitions: str | None = None) -> FeedSpec:
        """Build a spec from string-valued feed settings as the batch jobs kept them: source_table, target_table,
        history_table, a comma-separated primary_key, and incrementalload, which loads increments only if it is exactly
        'true'. A missing or blank num_partitions is the jobs' default; pass '0' for split-sized files."""
        def named(key: str) -> str | None:
            table = options.get(key)
            return f"{database}.{table}" if table and database and "." not in table else table or None

        count = DEFAULT_NUM_PARTITIONS if num_partitions is None or not num_partitions.strip() else int(num_partitions)
        return cls(
            pre_raw_table=named("source_table"),
            raw_table=named("target_table"),
            primary_key=tuple(split_list(options["primary_key"])),
            history_table=named("history_table"),
            incremental=options.get("incrementalload") == "true",
            num_partitions=count or None,
        )


def fanout_targets(options: Mapping[str, str]) -> list[str]:
    """The access folders of a feed's applications, in order: `sotapp` names them, and each has `<app>_access_bucket`, the
    zone's root, and `<app>_access_file_prefix` below it. A missing setting raises."""
    apps = split_list(options["sotapp"])
    return [f"{options[a + '_access_bucket'].rstrip('/')}/{options[a + '_access_file_prefix'].strip('/')}" for a in apps]


@dataclass(frozen=True)
class ReconSpec:
    """Reconciliation of a source extract against one stored batch of a raw table."""

    raw_table: str
    primary_key: tuple[str, ...]
    output_path: str
    input_table: str | None = None
    input_path: str | None = None
    file_type: str = "csv"  # "csv" or "json"; ignored when input_table is set
    delimiter: str = ","
    mapping: dict[str, str] = field(default_factory=dict)
    drop_columns: tuple[str, ...] = ()
    do_column_check: bool = True
    header: bool = False  # the reference reads a header line as data
    fill_both: bool = False  # the reference fills nulls with '' on the CSV side only
    null_safe: bool = False  # the reference does not flag a change to or from null
    # keys unique in raw (schema gate; the source's may repeat): difference and report from one keyed join instead of
    # a whole-row EXCEPT plus a profile join
    keyed: bool = False
    # few differences expected: digests by key bucket first, then the exact difference of unlike buckets alone
    # (operators.pruned_difference states the bound on a chance miss); keyed takes precedence
    pruned: bool = False

    @classmethod
    def from_options(cls, options: Mapping[str, str], raw_table: str, output_path: str,
                     input_path: str | None = None, do_column_check: str | int | bool = 1) -> ReconSpec:
        """Build a spec from string-valued reconciliation settings as the batch jobs kept them: a
        comma-separated primary_key and drop_columns, a JSON object in mapping_details, and 'None' for
        unset input_table / mapping_details."""
        def opt(name: str) -> str | None:
            v = options.get(name)
            return None if v is None or v == "None" else v

        mapping = opt("mapping_details")
        return cls(
            raw_table=raw_table,
            primary_key=tuple(split_list(options["primary_key"])),
            output_path=output_path,
            input_table=opt("input_table"),
            input_path=input_path,
            file_type=(opt("file_extension") or "csv").lower(),
            delimiter=opt("delimiter") or ",",
            mapping=json.loads(mapping) if mapping else {},
            drop_columns=tuple(split_list(opt("drop_columns") or "")),
            do_column_check=str(do_column_check).strip().lower() in ("1", "true"),
        )


@dataclass(frozen=True)
class RequestSpec:
    """A data request delivered into a Parquet target table in an access zone."""

    accesszone_id: str
    request_id: str
    database: str  # substituted for the template's database placeholder
    sql_template: str
    target_suffix: str = "delivery"  # target table: <zone>_<request>_<suffix>, '-' replaced by '_'

    @property
    def target_name(self) -> str:
        return f"{self.accesszone_id}_{self.request_id}_{self.target_suffix}".replace("-", "_")
