"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Queries over sinks write into fresh folders/tables below the session's shared folder and read the
result back, so that the written data itself is what is compared with the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake import fixtures as fx
from feedlake.functions import (
    array_to_string,
    cast_to_schema,
    drop_batchdate,
    drop_columns,
    fill_empty_strings,
    keys_with_label,
    mismatch_array,
    prefix_nonkey,
    rename_columns,
    with_batchdate,
)
from feedlake.operators import (
    anti_join_keys,
    concat,
    count_batch,
    count_by_batch,
    count_rows,
    count_unchanged,
    difference,
    full_refresh,
    incremental_snapshot,
    is_empty,
    latest_batch,
    mismatch_flags,
    mismatch_report,
    pair_on_keys,
    recon_mismatch,
    recon_new_records,
    snapshot_date,
    unchanged_records,
    unmatched_rows,
    where_batch,
)
from feedlake.operators.keyfilter import DEFAULT_BITS
from feedlake.plans import (
    deliver_request,
    history_snapshot,
    ingest_partition,
    post_batch_audit,
    recon_difference,
    reconcile,
    run_request_sql,
    schema_checks,
    validate_files,
)
from feedlake.sinks import (
    append_raw,
    audit_events,
    coalesce_output,
    create_feed_table,
    create_target,
    load_target,
    overwrite_partition,
    overwrite_raw,
    publish_fanout,
    read_audit,
    read_file_ledger,
    record_audit,
    stage_arrivals,
    stage_feed,
    stage_landing,
    write_diff_json,
    write_info_csv,
)
from feedlake.sources import (
    TEXT_OPTIONS,
    access_zone_lookup,
    landing_manifest,
    requested_columns,
    scan_batch,
    scan_delimited,
    scan_json,
    scan_recon_source,
    scan_table,
)
from feedlake.spec import BATCH_COLUMN, RequestSpec, ReconSpec
from feedlake.workspace import materialize, new_dir, new_name, small_tasks

Query = Callable[[SparkSession, str], DataFrame]
KEYS = [fx.ORDER_KEY]
NONKEY = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ZONE = "nation_7"
REQUEST = "req-europe"


# ---- fixtures shared by several queries -------------------------------------------------------------


def _diff(spark: SparkSession, sf: str) -> DataFrame:
    return recon_difference(fx.recon_source(spark, sf), fx.recon_raw(spark, sf))


def _compared(spark: SparkSession, sf: str, build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The rows of `build(raw, difference)`; the difference, which branches of it may share, and they are computed in small tasks."""
    raw = fx.recon_raw(spark, sf)
    with small_tasks(spark, 2 * raw.count()):  # the source is about as large
        return materialize(build(raw, materialize(_diff(spark, sf), "difference")), "compared")


def _feed_table(spark: SparkSession, df: DataFrame, label: str, partitioned: bool = True) -> str:
    """An empty external feed table with df's schema (batchdate last) in a fresh work database."""
    db = fx.work_database(spark)
    name = f"{db}.{label}"
    create_feed_table(spark, name, df.schema, new_dir(spark, label), partitioned)
    return name


def _daily_table(spark: SparkSession, sf: str) -> str:
    """daily_events stored as a table partitioned by batchdate (one append writes all days)."""
    ev = fx.daily_events(spark, sf)
    name = _feed_table(spark, ev, "daily_events")
    append_raw(ev, name)
    return name


def _history_table(spark: SparkSession, sf: str) -> str:
    h = fx.history(spark, sf)
    name = _feed_table(spark, h, "history")
    append_raw(h, name)
    return name


def _orders_schema(spark: SparkSession, sf: str) -> StructType:
    return fx.table(spark, sf, "orders").schema


# ---- 2.1 sources -------------------------------------------------------------------------------------


def q_scan_table(spark, sf):
    db = fx.source_database(spark, sf, ["orders"])
    return scan_table(spark, f"{db}.orders")


def q_scan_batch(spark, sf):
    return scan_batch(spark, _daily_table(spark, sf), fx.AUDIT_DAY)


def q_scan_delimited(spark, sf):
    path = fx.write_delimited(fx.table(spark, sf, "orders"), new_dir(spark, "orders_csv"))
    return scan_delimited(spark, path, _orders_schema(spark, sf), fx.LANDING_SEP)


def q_scan_json(spark, sf):
    path = new_dir(spark, "orders_json")
    fx.table(spark, sf, "orders").write.options(**TEXT_OPTIONS).json(path)
    return scan_json(spark, path, _orders_schema(spark, sf))


def _recon_csv(spark, sf) -> str:
    return fx.write_delimited(fx.recon_source(spark, sf), new_dir(spark, "recon_source_csv"))


def q_scan_recon_source(spark, sf):
    spec = ReconSpec(raw_table="", primary_key=tuple(KEYS), output_path="", input_path=_recon_csv(spark, sf),
                     file_type="csv", delimiter=fx.LANDING_SEP)
    return scan_recon_source(spark, spec, _orders_schema(spark, sf))


def q_landing_manifest(spark, sf):
    m = landing_manifest(spark, fx.write_landing(spark, sf), "csv")
    day = F.regexp_extract("path", r"batchdate=(\d{4}-\d{2}-\d{2})", 1)
    # the listed (day, compression) pairs; file counts per day follow the writer's input splits
    return m.select(day.alias(BATCH_COLUMN), "compressed").distinct()


def q_access_zone_lookup(spark, sf):
    return access_zone_lookup(fx.access_zones(spark, sf, "zones"), ZONE)


def q_requested_columns(spark, sf):
    return requested_columns(fx.request_columns(spark, sf), REQUEST)


# ---- 2.2 sinks ---------------------------------------------------------------------------------------


def q_overwrite_raw(spark, sf):
    raw = _history_table(spark, sf)  # two old batches; a full overwrite must remove both
    overwrite_raw(fx.table(spark, sf, "orders"), raw, fx.DELTA_DATE)
    return spark.table(raw)


def q_append_raw(spark, sf):
    raw = _history_table(spark, sf)
    overwrite_raw(fx.delta(spark, sf), raw, fx.DELTA_DATE)
    append_raw(unchanged_records(fx.history(spark, sf), fx.delta(spark, sf), KEYS), raw)
    return spark.table(raw)


def _doubled_day(spark, sf) -> DataFrame:
    ev = fx.daily_events(spark, sf)
    return where_batch(ev, fx.AUDIT_DAY).withColumn("value", F.col("value") * 2)


def q_overwrite_partition(spark, sf):
    name = _daily_table(spark, sf)
    overwrite_partition(drop_batchdate(_doubled_day(spark, sf)), name, fx.AUDIT_DAY)
    return spark.table(name)


def q_write_diff_json(spark, sf):
    path = new_dir(spark, "difference")
    d = _diff(spark, sf)
    write_diff_json(d, path)
    return scan_json(spark, path, d.schema)


def q_write_info_csv(spark, sf):
    path = new_dir(spark, "additional_info")
    write_info_csv(_compared(spark, sf, lambda raw, d: mismatch_report(raw, d, KEYS)), path)
    return scan_delimited(spark, path, StructType.fromDDL("o_orderkey bigint, column_name string"), ",", header=True)


def _target(spark, sf) -> tuple[str, list[tuple[str, str]]]:
    db = fx.work_database(spark)
    cols = [(r["requestecol"], r["dtype"]) for r in requested_columns(fx.request_columns(spark, sf), REQUEST).collect()]
    name = f"{db}.{new_name('target')}"
    create_target(spark, name, cols, new_dir(spark, "target"))
    return name, cols


def q_create_target(spark, sf):
    """The created target as a scan finds it after one insert of each requested name: customers by the declared columns."""
    name, cols = _target(spark, sf)
    c = fx.table(spark, sf, "customer")
    c.select(*[(F.col(n) if n in c.columns else F.lit(None)).cast(t).alias(n) for n, t in cols]).write.insertInto(name)
    return spark.table(name)


def q_load_target(spark, sf):
    name, _ = _target(spark, sf)
    c, o = fx.table(spark, sf, "customer"), fx.table(spark, sf, "orders")
    result = (
        c.join(o, c.c_custkey == o.o_custkey)
        .groupBy(c.c_custkey, c.c_name)
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price"))
    )
    load_target(result, name)
    return spark.table(name)


def q_publish_fanout(spark, sf):
    """Rows of both targets: every batch at once to a and b, then one day, doubled, as one batch to b and c."""
    ev = fx.daily_events(spark, sf)
    targets = {label: new_dir(spark, f"zone_{label}") for label in "abc"}
    publish_fanout(ev, [targets["a"], targets["b"]])
    publish_fanout(_doubled_day(spark, sf), [targets["b"], targets["c"]], fx.AUDIT_DAY)
    read = [spark.read.schema(ev.schema).parquet(t).withColumn("target", F.lit(label)) for label, t in targets.items()]
    return read[0].unionByName(read[1]).unionByName(read[2])


def q_stage_landing(spark, sf):
    landing = fx.write_landing(spark, sf)
    schema = fx.daily_events(spark, sf).schema
    staged = stage_landing(spark, landing, new_dir(spark, "pre_raw"), schema, fx.LANDING_SEP, "csv")
    return staged.drop("source_file", "rejected_line")


def _staged_feed(spark, sf) -> tuple[str, str]:
    """Landing files with some lines of too few fields, staged: the pre-raw and the quarantine table."""
    db = fx.work_database(spark)
    stage_feed(spark, fx.write_damaged_landing(spark, sf), f"{db}.pre_raw", f"{db}.quarantine", new_dir(spark, "staged"),
               fx.daily_events(spark, sf).schema, fx.LANDING_SEP, "csv")
    return f"{db}.pre_raw", f"{db}.quarantine"


def q_stage_feed(spark, sf):
    return spark.table(_staged_feed(spark, sf)[0]).drop("source_file")


def q_stage_quarantine(spark, sf):
    bad = spark.table(_staged_feed(spark, sf)[1])
    return bad.select("rejected_line", F.col("source_file").endswith(".csv").alias("from_csv"), BATCH_COLUMN)


def _arrivals(spark, sf) -> tuple[str, str, str]:
    """Odd days' files staged, then even days' files and damaged lines of every day: pre-raw, quarantine, file ledger."""
    db, ledger, root, ev = fx.work_database(spark), new_dir(spark, "files"), new_dir(spark, "landing"), fx.daily_events(spark, sf)
    odd = F.dayofmonth("ts") % 2 == 1
    for add in (lambda: fx.write_days(ev.where(odd), root), lambda: (fx.write_days(ev.where(~odd), root, "gzip"), fx.add_damaged_lines(ev, root, "event_id"))):
        add()
        stage_arrivals(spark, root, f"{db}.pre_raw", f"{db}.quarantine", f"{root}-staged", ledger, ev.schema, fx.LANDING_SEP, "csv")
    return f"{db}.pre_raw", f"{db}.quarantine", ledger


def q_stage_arrivals(spark, sf):
    """Both tables after two runs over a growing folder."""
    pre, quarantine, _ = _arrivals(spark, sf)
    bad = spark.table(quarantine).drop("source_file")
    return spark.table(pre).drop("source_file").unionByName(bad, allowMissingColumns=True)


def q_new_arrivals(spark, sf):
    """What the second run took: batches, and whether their files are compressed."""
    ledger = read_file_ledger(spark, _arrivals(spark, sf)[2])
    second = ledger.where(F.col("staged_at") > ledger.select(F.min("staged_at")).scalar())
    return second.select(BATCH_COLUMN, F.col("path").endswith(".gz").alias("compressed")).distinct()


def q_record_audit(spark, sf):
    path = new_dir(spark, "audit")
    counts = count_by_batch(fx.daily_events(spark, sf))
    ev = audit_events(counts, "landing_to_raw", "post_batch_audit", "daily_events", "Delta Count Raw",
                      {"count": F.col("cnt"), "batchdate": F.col(BATCH_COLUMN)})
    record_audit(spark, path, ev)
    a = read_audit(spark, path)
    return a.select("message", a.args["batchdate"].alias(BATCH_COLUMN), a.args["count"].cast("bigint").alias("cnt"))


def q_coalesce_output(spark, sf):
    path = new_dir(spark, "coalesced")
    coalesce_output(fx.table(spark, sf, "events"), 2).write.parquet(path)
    return spark.read.parquet(path)


# ---- 2.3 projections ---------------------------------------------------------------------------------


def q_with_batchdate(spark, sf):
    return with_batchdate(fx.table(spark, sf, "orders"), fx.DELTA_DATE)


def q_drop_batchdate(spark, sf):
    return drop_batchdate(fx.daily_events(spark, sf))


def q_drop_columns(spark, sf):
    return drop_columns(fx.table(spark, sf, "orders"), "o_totalprice, o_orderdate, not_a_column")


def q_rename_columns(spark, sf):
    return rename_columns(fx.table(spark, sf, "orders"), {"o_orderpriority": "priority", "not_a_column": "x"})


def q_prefix_nonkey(spark, sf):
    return prefix_nonkey(fx.table(spark, sf, "orders"), "O_ORDERKEY", "df_raw_")


def q_keys_with_label(spark, sf):
    return keys_with_label(_diff(spark, sf), KEYS, "new record")


def _damaged_orders(spark, sf) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    k = F.col(fx.ORDER_KEY)
    return o.select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 11 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderstatus",
    )


def q_cast_to_schema(spark, sf):
    return cast_to_schema(_damaged_orders(spark, sf), "o_orderkey bigint, o_totalprice double, o_orderdate date")


# ---- 2.4 / 2.5 filters and joins --------------------------------------------------------------------


def q_where_batch(spark, sf):
    return where_batch(fx.history(spark, sf), fx.HISTORY_OLDER)


def q_latest_batch(spark, sf):
    return latest_batch(fx.history(spark, sf))


def q_unmatched_rows(spark, sf):
    return unmatched_rows(fx.history(spark, sf), fx.delta(spark, sf), KEYS)


def q_unchanged_records(spark, sf):
    return unchanged_records(fx.history(spark, sf), fx.delta(spark, sf), KEYS)


def q_unchanged_records_filtered(spark, sf):
    """The same past a bitmap of the delta's keys."""
    return unchanged_records(fx.history(spark, sf), fx.delta(spark, sf), KEYS, filter_bits=DEFAULT_BITS)


def q_pair_on_keys(spark, sf):
    return _compared(spark, sf, lambda raw, d: pair_on_keys(raw, d, KEYS))


def q_anti_join_keys(spark, sf):
    return _compared(spark, sf, lambda raw, d: anti_join_keys(d, raw, KEYS))


# ---- 2.6 aggregations ---------------------------------------------------------------------------------


def _snapshot(spark, sf) -> DataFrame:
    return incremental_snapshot(fx.delta(spark, sf), fx.history(spark, sf), KEYS, fx.DELTA_DATE)


def q_count_rows(spark, sf):
    return count_rows(_snapshot(spark, sf))


def q_count_batch(spark, sf):
    return count_batch(fx.daily_events(spark, sf), fx.AUDIT_DAY)


def q_count_by_batch(spark, sf):
    return count_by_batch(_snapshot(spark, sf))


def q_count_unchanged(spark, sf):
    return count_unchanged(fx.history(spark, sf), fx.delta(spark, sf), KEYS)


def q_snapshot_date(spark, sf):
    return snapshot_date(_snapshot(spark, sf))


def q_is_empty(spark, sf):
    """The answer for the difference, and for the difference of the stored batch with itself, which is empty."""
    raw = fx.recon_raw(spark, sf)
    answers = [is_empty(_diff(spark, sf)).withColumn("of", F.lit("difference")),
               is_empty(difference(raw, raw)).withColumn("of", F.lit("itself"))]
    return answers[0].unionByName(answers[1])


# ---- 2.9 / 2.10 set operations and scalar functions ---------------------------------------------------


def q_except_distinct(spark, sf):
    # (user, type, day) triples that never had a value above 25: duplicates collapse, nulls compare equal
    ev = fx.daily_events(spark, sf)
    cols = ["user_id", "event_type", BATCH_COLUMN]
    return difference(ev.select(*cols), ev.where(F.col("value") > 25).select(*cols))


def q_union_all(spark, sf):
    return _compared(spark, sf, lambda raw, d: concat(recon_mismatch(raw, d, KEYS), recon_new_records(d, raw, KEYS)))


def _flagged(spark, sf) -> tuple[DataFrame, list]:
    """Difference rows next to their key's raw values, and the shipped flag of each compared column."""
    p = _compared(spark, sf, lambda raw, d: pair_on_keys(raw, d, KEYS))
    return p, mismatch_flags({f.name: f.dataType for f in _diff(spark, sf).schema.fields}, NONKEY)


def q_mismatch_flags(spark, sf):
    p, flags = _flagged(spark, sf)
    return p.select(fx.ORDER_KEY, *[f.alias(f"flag_{c}") for f, c in zip(flags, NONKEY)])


def q_mismatch_array(spark, sf):
    p, flags = _flagged(spark, sf)
    arr = mismatch_array(flags)
    return p.select(fx.ORDER_KEY, F.size(arr).alias("n_mismatch"), F.array_join(arr, "|").alias("columns"))


def q_array_to_string(spark, sf):
    p, flags = _flagged(spark, sf)
    return p.select(fx.ORDER_KEY, array_to_string(mismatch_array(flags)).alias("column_name"))


def q_fill_empty_strings(spark, sf):
    return fill_empty_strings(fx.null_strings(spark, sf))


def q_run_request_sql(spark, sf):
    db = fx.source_database(spark, sf, ["customer", "orders"])
    return run_request_sql(spark, fx.REQUEST_SQL, db)


# ---- 2.13 pipelines -----------------------------------------------------------------------------------


def q_incremental_snapshot(spark, sf):
    return _snapshot(spark, sf)


def q_full_refresh(spark, sf):
    return full_refresh(fx.table(spark, sf, "orders"), fx.DELTA_DATE)


def q_history_snapshot(spark, sf):
    hist = _history_table(spark, sf)
    snap = _snapshot(spark, sf)
    raw = _feed_table(spark, snap, "raw")
    overwrite_raw(snap, raw)
    history_snapshot(spark, raw, hist)  # partition = raw's max batchdate
    return spark.table(hist)


def q_ingest_partition(spark, sf):
    name = _daily_table(spark, sf)
    ingest_partition(spark, _doubled_day(spark, sf), name, fx.AUDIT_DAY)
    return spark.table(name)


def q_post_batch_audit(spark, sf):
    snap = _snapshot(spark, sf)
    raw = _feed_table(spark, snap, "raw")
    overwrite_raw(snap, raw)
    path = new_dir(spark, "audit")
    post_batch_audit(spark, raw, fx.DELTA_DATE, path, "orders")
    a = read_audit(spark, path)
    return a.select("message", a.args["batchdate"].alias(BATCH_COLUMN), a.args["count"].cast("bigint").alias("cnt"))


def q_recon_difference(spark, sf):
    return _diff(spark, sf)


def q_recon_mismatch(spark, sf):
    return _compared(spark, sf, lambda raw, d: recon_mismatch(raw, d, KEYS))


def q_recon_new_records(spark, sf):
    return _compared(spark, sf, lambda raw, d: recon_new_records(d, raw, KEYS))


def q_recon_difference_pruned(spark, sf):
    """The same rows, read from key buckets whose digests differ."""
    return recon_difference(fx.recon_source(spark, sf), fx.recon_raw(spark, sf), pruned_by=KEYS)


def q_recon_report(spark, sf, keyed: bool = False):
    raw = _feed_table(spark, fx.table(spark, sf, "orders").withColumn(BATCH_COLUMN, F.lit(fx.DELTA_DATE)), "raw")
    overwrite_raw(fx.recon_raw(spark, sf), raw, fx.DELTA_DATE)
    spec = ReconSpec(raw_table=raw, primary_key=("O_ORDERKEY",), output_path=new_dir(spark, "recon"),
                     input_path=_recon_csv(spark, sf), file_type="csv", delimiter=fx.LANDING_SEP, keyed=keyed)
    res = reconcile(spark, spec, fx.DELTA_DATE)
    schema = StructType.fromDDL("o_orderkey bigint, column_name string")
    return scan_delimited(spark, res["info_path"], schema, ",", header=True)


def q_recon_report_keyed(spark, sf):
    """PIP-9 in keyed mode (orders keys are unique, the extract's new keys may meet them): one keyed join instead of EXCEPT + profile join."""
    return q_recon_report(spark, sf, keyed=True)


def q_file_table_validation(spark, sf):
    table = fx.null_strings(spark, sf)
    files = fx.write_delimited(table, new_dir(spark, "pre_raw_files"))
    _, diff = validate_files(spark, files, table, fx.LANDING_SEP, new_dir(spark, "validation"))
    return diff


SCHEMA_TARGET = [
    ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_quantity", "int"),
    ("l_returnflag", "int"), ("l_shipdate", "date"), ("l_comment", "string"),
]


def q_schema_validation(spark, sf):
    return schema_checks(fx.table(spark, sf, "lineitem"), SCHEMA_TARGET, "l_orderkey, l_linenumber")


def q_schema_evidence(spark, sf):
    """The same report with the violating rows that sort first and last."""
    return schema_checks(fx.table(spark, sf, "lineitem"), SCHEMA_TARGET, "l_orderkey, l_linenumber", evidence=True)


def q_deliver_request(spark, sf):
    src = fx.source_database(spark, sf, ["customer", "orders"])
    zones = fx.access_zones(spark, sf, new_dir(spark, "zones"))
    spec = RequestSpec(accesszone_id=ZONE, request_id=REQUEST, database=src, sql_template=fx.REQUEST_SQL)
    # zone databases are shared names (zone_db_<region>); the target name is unique per request
    target = deliver_request(spark, spec, zones, fx.request_columns(spark, sf))
    return spark.table(target)


def _feed_batches(orders: DataFrame) -> list[tuple[str, DataFrame]]:
    k = F.col(fx.ORDER_KEY)
    return [
        ("2024-01-01", orders),
        ("2024-01-02", orders.where(k % 10 >= 7).withColumn("o_orderstatus", F.lit("U"))),
        ("2024-01-03", orders.where(k % 10 == 0).withColumn("o_orderstatus", F.lit("V"))),
    ]


def q_run_feed(spark, sf):
    """Three daily batches end to end (schema gate, raw, history, audit); the final raw image."""
    from feedlake.plans import run_feed
    from feedlake.spec import FeedSpec

    db = fx.work_database(spark)
    orders = fx.table(spark, sf, "orders")
    stamped = orders.withColumn(BATCH_COLUMN, F.lit("2001-01-31"))
    for t in ("raw", "history"):
        create_feed_table(spark, f"{db}.{t}", stamped.schema, new_dir(spark, t))
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history",
                    primary_key=("o_orderkey",))
    for day, delta in _feed_batches(orders):
        pre = new_dir(spark, "pre_raw")
        delta.write.parquet(pre)
        spark.sql(f"DROP TABLE IF EXISTS {spec.pre_raw_table}")
        spark.catalog.createTable(spec.pre_raw_table, path=pre, source="parquet")
        run_feed(spark, spec, day, new_dir(spark, "audit"))
    return spark.table(spec.raw_table)


def q_run_feed_journalled(spark, sf):
    """The same three batches through a journal, each called twice; every audit event, which the second call leaves once."""
    from feedlake.plans import run_feed
    from feedlake.spec import FeedSpec

    db = fx.work_database(spark)
    orders = fx.table(spark, sf, "orders")
    for t in ("raw", "history"):
        create_feed_table(spark, f"{db}.{t}", orders.withColumn(BATCH_COLUMN, F.lit("2001-01-31")).schema, new_dir(spark, t))
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history", primary_key=("o_orderkey",))
    ledger, audit = new_dir(spark, "ledger"), new_dir(spark, "audit")
    for day, delta in _feed_batches(orders):
        pre = new_dir(spark, "pre_raw")
        delta.write.parquet(pre)
        spark.sql(f"DROP TABLE IF EXISTS {spec.pre_raw_table}")
        spark.catalog.createTable(spec.pre_raw_table, path=pre, source="parquet")
        for _ in range(2):
            run_feed(spark, spec, day, audit, ledger_path=ledger)
    a = read_audit(spark, audit)
    return a.select("message", a.args["batchdate"].alias(BATCH_COLUMN), a.args["value"].alias("value"))


def q_run_landing(spark, sf):
    """The same three batches from landing files, some lines of which do not fit: staged, gated, loaded; the final raw image."""
    from feedlake.plans import run_landing
    from feedlake.spec import FeedSpec

    db = fx.work_database(spark)
    orders = fx.table(spark, sf, "orders")
    for t in ("raw", "history"):
        create_feed_table(spark, f"{db}.{t}", orders.withColumn(BATCH_COLUMN, F.lit("2001-01-31")).schema, new_dir(spark, t))
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history", primary_key=("o_orderkey",))
    landing, staged, audit = new_dir(spark, "landing"), new_dir(spark, "staged"), new_dir(spark, "audit")
    for day, delta in _feed_batches(orders):
        fx.add_landing_batch(delta.withColumn(BATCH_COLUMN, F.lit(day)), landing, fx.ORDER_KEY)
        run_landing(spark, spec, day, landing, f"{db}.quarantine", staged, fx.LANDING_SEP, audit_path=audit)
    return spark.table(spec.raw_table)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
