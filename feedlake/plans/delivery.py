"""Request delivery (PIP-12, FN-7): control lookups, target (re)creation, request SQL, overwrite."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from feedlake.sinks.tables import replace_target
from feedlake.sources.control import access_zone_lookup, requested_columns
from feedlake.spec import RequestSpec

# Fixed value: the placeholder request templates use for the source database.
DB_PLACEHOLDER = "{athena_raw_db}"
_DB = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def render_request_sql(template: str, database: str) -> str:
    """Substitute the database placeholder; the rest of the template, comments and line breaks too, is left as it is."""
    if not _DB.match(database):
        raise ValueError(f"not a database name: {database!r}")
    return template.replace(DB_PLACEHOLDER, database)


def run_request_sql(spark: SparkSession, template: str, database: str, **args) -> DataFrame:
    """FN-7: the request's query as a lazy DataFrame; named parameters are passed as SQL parameters."""
    return spark.sql(render_request_sql(template, database), args=args or None)


def resolve_zone(zones: DataFrame, zone_id: str) -> tuple[str, str]:
    """Exactly one registry row must match the zone (two rows are fetched at most)."""
    rows = access_zone_lookup(zones, zone_id).take(2)
    if len(rows) != 1:
        raise ValueError(f"access zone {zone_id!r}: expected one registry row, found {len(rows)}")
    return rows[0]["s3_location"], rows[0]["database_name"]


def deliver_request(
    spark: SparkSession, spec: RequestSpec, zones: DataFrame, columns: DataFrame
) -> str:
    """PIP-12: run the request SQL against spec.database and put its result, with the requested columns, in the place of
    <zone db>.<target> at the zone's location. Returns the table name. The old target stays until the new rows are
    all written, so a request that fails leaves it whole (`replace_target`)."""
    location, zone_db = resolve_zone(zones, spec.accesszone_id)
    # one row per requested column: metadata, bounded by the width of the target
    cols = [(r["requestecol"], r["dtype"]) for r in requested_columns(columns, spec.request_id).collect()]
    target = f"{zone_db}.{spec.target_name}"
    if not _DB.match(zone_db):
        raise ValueError(f"not a database name: {zone_db!r}")
    if "'" in location or "\\" in location or any(ord(c) < 32 for c in location):
        raise ValueError(f"not a location: {location!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {zone_db} LOCATION '{location.rstrip('/')}/{zone_db}.db'")
    result = run_request_sql(spark, spec.sql_template, spec.database)
    replace_target(result, target, cols, f"{location.rstrip('/')}/{spec.target_name}")
    return target
