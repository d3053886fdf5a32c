"""DuckDB SQL for every registered query, over the driver's pre-registered views."""

from __future__ import annotations

# Fixture CTEs (FIXTURES.md section 3); each mirrors feedlake.fixtures.
HISTORY = """history AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         '2024-01-01' AS batchdate
  FROM orders WHERE o_orderkey % 10 <> 9
  UNION ALL
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         '2023-12-01' AS batchdate
  FROM orders WHERE o_orderkey % 10 < 5)"""

DELTA = """delta AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 10 >= 7)"""

LATEST = """latest AS (
  SELECT * FROM history WHERE batchdate = (SELECT max(batchdate) FROM history))"""

UNCHANGED = """unchanged AS (
  SELECT l.* FROM latest l WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = l.o_orderkey))"""

SNAPSHOT = """snapshot AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         '2024-01-02' AS batchdate FROM delta
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, batchdate
  FROM unchanged)"""

RECON_SOURCE = """recon_source AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 10 = 2 THEN 'Z' WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderstatus END
           AS o_orderstatus,
         o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 10 IN (1, 2) THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 13 <> 0
  UNION ALL
  SELECT o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 50 = 0)"""

DIFF = """diff AS (SELECT * FROM recon_source EXCEPT SELECT * FROM orders)"""

# the CSV path fills string nulls with '' on the source side only
RECON_SOURCE_CSV = """recon_source_csv AS (
  SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, '') AS o_orderstatus, o_totalprice, o_orderdate,
         coalesce(o_orderpriority, '') AS o_orderpriority FROM recon_source)"""

DIFF_CSV = """diff_csv AS (SELECT * FROM recon_source_csv EXCEPT SELECT * FROM orders)"""

DAILY = """daily AS (SELECT *, strftime(ts, '%Y-%m-%d') AS batchdate FROM events)"""

DOUBLED_DAY = """doubled_day AS (
  SELECT event_id, ts, user_id, event_type, value * 2 AS value, props, batchdate FROM daily
  WHERE batchdate = '2024-01-15')"""

NULL_STRINGS = """null_strings AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority FROM orders)"""

NONKEY = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _flags(d: str = "d", r: str = "r") -> str:
    return ", ".join(f"CASE WHEN {r}.{c} <> {d}.{c} THEN '{c}' END" for c in NONKEY)


def mismatch_sql(diff: str) -> str:
    return (
        f"SELECT d.o_orderkey, '[' || concat_ws(', ', {_flags()}) || ']' AS column_name "
        f"FROM {diff} d JOIN orders r ON r.o_orderkey = d.o_orderkey"
    )


def new_records_sql(diff: str) -> str:
    return (
        f"SELECT d.o_orderkey, 'new record' AS column_name FROM {diff} d "
        f"WHERE NOT EXISTS (SELECT 1 FROM orders r WHERE r.o_orderkey = d.o_orderkey)"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


REQUEST = """SELECT c.c_custkey, c.c_name, count(*) AS n_orders, max(o.o_totalprice) AS max_price
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey, c.c_name"""

SNAP = with_(HISTORY, DELTA, LATEST, UNCHANGED, SNAPSHOT)
RECON = with_(RECON_SOURCE, DIFF)

ORACLE: dict[str, str] = {
    "incremental_snapshot": SNAP + "SELECT * FROM snapshot",
}

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

ORACLE.update({
    # 2.1 sources
    "scan_table": "SELECT * FROM orders",
    "scan_batch": with_(DAILY) + "SELECT * FROM daily WHERE batchdate = '2024-01-15'",
    "scan_delimited": "SELECT * FROM orders",
    "scan_json": "SELECT * FROM orders",
    "scan_recon_source": with_(RECON_SOURCE, RECON_SOURCE_CSV) + "SELECT * FROM recon_source_csv",
    "landing_manifest": with_(DAILY) + """SELECT DISTINCT batchdate, (dayofmonth(ts) % 2 = 0) AS compressed
        FROM daily""",
    "access_zone_lookup": """SELECT 'zones/zone_' || CAST(n_nationkey AS VARCHAR) AS s3_location,
        'zone_db_' || CAST(n_regionkey AS VARCHAR) AS database_name FROM nation WHERE lower(n_name) = 'nation_7'""",
    "requested_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS requestecol, '{t}' AS dtype FROM region "
        "WHERE 'req-' || replace(lower(r_name), ' ', '_') = 'req-europe'"
        for c, t in [("c_custkey", "bigint"), ("c_name", "string"), ("n_orders", "bigint"), ("max_price", "double")]
    ),
    # 2.2 sinks
    "overwrite_raw": "SELECT *, '2024-01-02' AS batchdate FROM orders",
    "append_raw": SNAP + "SELECT * FROM snapshot",
    "overwrite_partition": with_(DAILY) + """SELECT event_id, ts, user_id, event_type,
        CASE WHEN batchdate = '2024-01-15' THEN value * 2 ELSE value END AS value, props, batchdate FROM daily""",
    "write_diff_json": RECON + "SELECT * FROM diff",
    "write_info_csv": RECON + mismatch_sql("diff") + " UNION ALL " + new_records_sql("diff"),
    "create_target": """SELECT c_custkey, c_name, CAST(NULL AS BIGINT) AS n_orders, CAST(NULL AS DOUBLE) AS max_price
        FROM customer""",
    "load_target": REQUEST,
    "publish_fanout": with_(DAILY, DOUBLED_DAY) + """SELECT *, 'a' AS target FROM daily
        UNION ALL SELECT *, 'b' AS target FROM daily WHERE batchdate <> '2024-01-15'
        UNION ALL SELECT *, 'b' AS target FROM doubled_day UNION ALL SELECT *, 'c' AS target FROM doubled_day""",
    "stage_landing": with_(DAILY) + "SELECT * FROM daily",
    "stage_feed": with_(DAILY) + "SELECT * FROM daily",
    "stage_quarantine": with_(DAILY) + """SELECT CAST(event_id AS VARCHAR) || '|broken' AS rejected_line, true AS from_csv,
        batchdate FROM daily WHERE event_id % 50 = 0""",
    "stage_arrivals": with_(DAILY) + """SELECT *, CAST(NULL AS VARCHAR) AS rejected_line FROM daily UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, batchdate, CAST(event_id AS VARCHAR) || '|broken' FROM daily
        WHERE event_id % 50 = 0""",
    "new_arrivals": with_(DAILY) + """SELECT DISTINCT batchdate, true AS compressed FROM daily WHERE dayofmonth(ts) % 2 = 0
        UNION ALL SELECT DISTINCT batchdate, false AS compressed FROM daily WHERE event_id % 50 = 0""",
    "record_audit": with_(DAILY) + """SELECT 'Delta Count Raw' AS message, batchdate, count(*) AS cnt
        FROM daily GROUP BY batchdate""",
    "coalesce_output": "SELECT * FROM events",
    # 2.3 projections
    "with_batchdate": "SELECT *, '2024-01-02' AS batchdate FROM orders",
    "drop_batchdate": "SELECT * FROM events",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "rename_columns": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority AS priority FROM orders""",
    "prefix_nonkey": """SELECT o_orderkey, o_custkey AS df_raw_o_custkey, o_orderstatus AS df_raw_o_orderstatus,
        o_totalprice AS df_raw_o_totalprice, o_orderdate AS df_raw_o_orderdate,
        o_orderpriority AS df_raw_o_orderpriority FROM orders""",
    "keys_with_label": RECON + "SELECT o_orderkey, 'new record' AS column_name FROM diff",
    "cast_to_schema": """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END
        AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
    # 2.4 / 2.5
    "where_batch": with_(HISTORY) + "SELECT * FROM history WHERE batchdate = '2023-12-01'",
    "latest_batch": with_(HISTORY, LATEST) + "SELECT * FROM latest",
    "unmatched_rows": with_(HISTORY, DELTA) + """SELECT h.* FROM history h
        WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = h.o_orderkey)""",
    "unchanged_records": with_(HISTORY, DELTA, LATEST, UNCHANGED) + "SELECT * FROM unchanged",
    "unchanged_records_filtered": with_(HISTORY, DELTA, LATEST, UNCHANGED) + "SELECT * FROM unchanged",
    "pair_on_keys": RECON + "SELECT d.o_orderkey, " + ", ".join(
        f"d.{c} AS df_diff_{c}, r.{c} AS df_raw_{c}_min, r.{c} AS df_raw_{c}_max" for c in NONKEY
    ) + ", CAST(1 AS BIGINT) AS df_raw__rows FROM diff d JOIN orders r ON r.o_orderkey = d.o_orderkey",
    "anti_join_keys": RECON + """SELECT d.* FROM diff d
        WHERE NOT EXISTS (SELECT 1 FROM orders r WHERE r.o_orderkey = d.o_orderkey)""",
    # 2.6
    "count_rows": SNAP + "SELECT count(*) AS cnt FROM snapshot",
    "count_batch": with_(DAILY) + "SELECT count(*) AS cnt FROM daily WHERE batchdate = '2024-01-15'",
    "count_by_batch": SNAP + "SELECT batchdate, count(*) AS cnt FROM snapshot GROUP BY batchdate",
    "count_unchanged": with_(HISTORY, DELTA, LATEST, UNCHANGED) + "SELECT count(*) AS unchangedcnt FROM unchanged",
    "snapshot_date": SNAP + "SELECT coalesce(max(batchdate), '2001-01-31') AS snapshot_date FROM snapshot",
    "is_empty": RECON + """SELECT (SELECT count(*) FROM diff) = 0 AS is_empty, 'difference' AS of
        UNION ALL SELECT (SELECT count(*) FROM (SELECT * FROM orders EXCEPT SELECT * FROM orders)) = 0, 'itself'""",
    # 2.9 / 2.10
    "except_distinct": with_(DAILY) + """SELECT user_id, event_type, batchdate FROM daily
        EXCEPT SELECT user_id, event_type, batchdate FROM daily WHERE value > 25""",
    "union_all": RECON + mismatch_sql("diff") + " UNION ALL " + new_records_sql("diff"),
    "mismatch_flags": RECON + "SELECT d.o_orderkey, " + ", ".join(
        f"CASE WHEN r.{c} <> d.{c} THEN '{c}' ELSE '' END AS flag_{c}" for c in NONKEY
    ) + " FROM diff d JOIN orders r ON r.o_orderkey = d.o_orderkey",
    "mismatch_array": RECON + "SELECT d.o_orderkey, CAST(" + " + ".join(
        f"(CASE WHEN r.{c} <> d.{c} THEN 1 ELSE 0 END)" for c in NONKEY
    ) + " AS INTEGER) AS n_mismatch, concat_ws('|', " + _flags() + ") AS columns "
      "FROM diff d JOIN orders r ON r.o_orderkey = d.o_orderkey",
    "array_to_string": RECON + mismatch_sql("diff"),
    "fill_empty_strings": with_(NULL_STRINGS) + """SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, '')
        AS o_orderstatus, o_totalprice, o_orderdate, coalesce(o_orderpriority, '') AS o_orderpriority
        FROM null_strings""",
    "run_request_sql": REQUEST,
    # 2.13
    "full_refresh": "SELECT *, '2024-01-02' AS batchdate FROM orders",
    "history_snapshot": SNAP + f"""SELECT * FROM history
        UNION ALL SELECT {ORDERS_COLS}, '2024-01-02' AS batchdate FROM snapshot""",
    "ingest_partition": with_(DAILY) + """SELECT event_id, ts, user_id, event_type,
        CASE WHEN batchdate = '2024-01-15' THEN value * 2 ELSE value END AS value, props, batchdate FROM daily""",
    "post_batch_audit": with_(DELTA) + """SELECT 'Delta Count Raw' AS message, '2024-01-02' AS batchdate,
        count(*) AS cnt FROM delta""",
    "recon_difference": RECON + "SELECT * FROM diff",
    "recon_mismatch": RECON + mismatch_sql("diff"),
    "recon_new_records": RECON + new_records_sql("diff"),
    "recon_report": with_(RECON_SOURCE, RECON_SOURCE_CSV, DIFF_CSV) + mismatch_sql("diff_csv") + " UNION ALL "
        + new_records_sql("diff_csv"),
    "file_table_validation": with_(NULL_STRINGS) + """SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, '')
        AS o_orderstatus, o_totalprice, o_orderdate, coalesce(o_orderpriority, '') AS o_orderpriority
        FROM null_strings EXCEPT SELECT * FROM null_strings""",
    "schema_validation": """
        SELECT 'missing_column' AS "check", 'l_comment' AS column_name, CAST(1 AS BIGINT) AS violations
        UNION ALL SELECT 'extra_column', c, 1 FROM (VALUES ('l_suppkey'), ('l_extendedprice'), ('l_discount'),
          ('l_tax'), ('l_linestatus')) AS t(c)
        UNION ALL SELECT 'column_order', c, 1 FROM (VALUES ('l_partkey'), ('l_linenumber')) AS t(c)
        UNION ALL SELECT 'uncastable', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NOT NULL AND TRY_CAST(l_orderkey AS BIGINT) IS NULL) FROM lineitem
        UNION ALL SELECT 'uncastable', 'l_linenumber', count(*) FILTER (WHERE l_linenumber IS NOT NULL AND TRY_CAST(l_linenumber AS INTEGER) IS NULL) FROM lineitem
        UNION ALL SELECT 'uncastable', 'l_partkey', count(*) FILTER (WHERE l_partkey IS NOT NULL AND TRY_CAST(l_partkey AS BIGINT) IS NULL) FROM lineitem
        UNION ALL SELECT 'uncastable', 'l_quantity', count(*) FILTER (WHERE l_quantity IS NOT NULL AND TRY_CAST(l_quantity AS INTEGER) IS NULL) FROM lineitem
        UNION ALL SELECT 'uncastable', 'l_returnflag', count(*) FILTER (WHERE l_returnflag IS NOT NULL AND TRY_CAST(l_returnflag AS INTEGER) IS NULL) FROM lineitem
        UNION ALL SELECT 'uncastable', 'l_shipdate', count(*) FILTER (WHERE l_shipdate IS NOT NULL AND TRY_CAST(l_shipdate AS DATE) IS NULL) FROM lineitem
        UNION ALL SELECT 'null_key', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
        UNION ALL SELECT 'null_key', 'l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
        UNION ALL SELECT 'duplicate_key', 'l_orderkey,l_linenumber', CAST(coalesce(sum(n), 0) AS BIGINT)
          FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "deliver_request": REQUEST,
    # three batches: carried rows show the last snapshot's date (2024-01-02), not the date they changed
    "run_feed": """SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderkey % 10 = 0 THEN 'V' WHEN o_orderkey % 10 >= 7 THEN 'U' ELSE o_orderstatus END
          AS o_orderstatus,
        o_totalprice, o_orderdate, o_orderpriority,
        CASE WHEN o_orderkey % 10 = 0 THEN '2024-01-03' ELSE '2024-01-02' END AS batchdate FROM orders""",
})
_FLAG = """CASE WHEN l_returnflag IS NOT NULL AND TRY_CAST(l_returnflag AS INTEGER) IS NULL THEN
  '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"value":"' || l_returnflag || '"}' END"""
_TWICE = """'{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"n":' || n || '}'"""
ORACLE["schema_evidence"] = f"""WITH report AS ({ORACLE["schema_validation"]}),
examples AS (
  SELECT 'uncastable' AS "check", 'l_returnflag' AS column_name, min({_FLAG}) AS first_example, max({_FLAG}) AS last_example
  FROM lineitem
  UNION ALL SELECT 'duplicate_key', 'l_orderkey,l_linenumber', min({_TWICE}), max({_TWICE})
  FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1))
SELECT r.*, e.first_example, e.last_example FROM report r LEFT JOIN examples e USING ("check", column_name)"""
ORACLE["recon_difference_pruned"] = ORACLE["recon_difference"]
ORACLE["run_feed_journalled"] = """WITH runs AS (
  SELECT '2024-01-01' AS batchdate, 0 AS base, 0 AS unchanged, count(*) AS delta FROM orders
  UNION ALL SELECT '2024-01-02', count(*), count(*) FILTER (WHERE o_orderkey % 10 < 7),
    count(*) FILTER (WHERE o_orderkey % 10 >= 7) FROM orders
  UNION ALL SELECT '2024-01-03', count(*), count(*) FILTER (WHERE o_orderkey % 10 <> 0),
    count(*) FILTER (WHERE o_orderkey % 10 = 0) FROM orders)
SELECT 'base table count' AS message, batchdate, CAST(base AS VARCHAR) AS value FROM runs
UNION ALL SELECT 'unchanged rec count', batchdate, CAST(unchanged AS VARCHAR) FROM runs
UNION ALL SELECT 'Delta Count Raw', batchdate, CAST(delta AS VARCHAR) FROM runs
UNION ALL SELECT 'Partition Date', batchdate, batchdate FROM runs"""
ORACLE["run_landing"] = ORACLE["run_feed"]
ORACLE["recon_report_keyed"] = ORACLE["recon_report"]
