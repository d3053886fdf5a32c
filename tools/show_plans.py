"""Print the physical plans of the headline pipelines (small-delta and large-delta variants) as Markdown."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from feedlake import fixtures as fx  # noqa: E402
from feedlake.operators import difference, incremental_snapshot, mismatch_report  # noqa: E402
from feedlake.plans.validate import schema_checks  # noqa: E402
from feedlake.registry import SCHEMA_TARGET  # noqa: E402
from feedlake.session import local_session  # noqa: E402
from feedlake.sinks import append_raw, create_feed_table  # noqa: E402
from feedlake.workspace import new_dir  # noqa: E402


def simplify(plan: str) -> str:
    plan = re.sub(r"Location: .*?, PartitionFilters", "PartitionFilters", plan)
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"file:/\S+", "<path>", plan)
    plan = re.sub(r"feedlake_work_[0-9a-f]+", "db", plan)
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    plan = re.sub(r"Format: Parquet, ", "", plan)
    return "\n".join(line[:260] for line in plan.splitlines())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    db = fx.work_database(spark)
    h = fx.history(spark, sf)
    for t in ("history", "history_b"):
        create_feed_table(spark, f"{db}.{t}", h.schema, new_dir(spark, t),
                          buckets=16 if t.endswith("_b") else None, bucket_keys=["o_orderkey"])
        append_raw(h, f"{db}.{t}")
    d = fx.delta(spark, sf)
    cases = [
        ("incremental snapshot, small delta (broadcast keys)", None,
         lambda: incremental_snapshot(d, spark.table(f"{db}.history"), ["o_orderkey"], "2024-01-02", latest="2024-01-01")),
        ("incremental snapshot, large delta (shuffle join)", "-1",
         lambda: incremental_snapshot(d, spark.table(f"{db}.history"), ["o_orderkey"], "2024-01-02", latest="2024-01-01")),
        ("incremental snapshot, large delta, history bucketed by key", "-1",
         lambda: incremental_snapshot(d.hint("rebalance", 16, "o_orderkey"), spark.table(f"{db}.history_b"), ["o_orderkey"],
                                      "2024-01-02", latest="2024-01-01")),
        ("reconciliation difference (EXCEPT DISTINCT), large inputs", "-1",
         lambda: difference(fx.recon_source(spark, sf), fx.recon_raw(spark, sf))),
        ("mismatch report over a materialised difference, large inputs", "-1",
         lambda: mismatch_report(fx.recon_raw(spark, sf), spark.read.parquet(_diff_path()), ["o_orderkey"])),
        ("schema gate", None,
         lambda: schema_checks(fx.table(spark, sf, "lineitem"), SCHEMA_TARGET, "l_orderkey, l_linenumber")),
    ]
    diff_path = new_dir(spark, "diff")
    difference(fx.recon_source(spark, sf), fx.recon_raw(spark, sf)).write.parquet(diff_path)
    global _diff_path
    _diff_path = lambda: diff_path

    print("# Physical plans of the headline pipelines\n")
    print("Generated by `python tools/show_plans.py` (sf0.01, local[8], AQE on; expression ids and paths removed).")
    print("\"Large\" variants disable the broadcast threshold to show the plan a big delta or extract gets.")
    print("These are the initial adaptive plans. In the EXCEPT plan the fixture's source is a union, so the raw side")
    print("appears once per branch; at run time AQE reuses that shuffle stage (the final plan holds one reused")
    print("exchange), so raw is shuffled once.\n")
    for title, threshold, build in cases:
        if threshold:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        df = build()
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        print(f"## {title}\n\n```\n{simplify(plan)}\n```\n")


_diff_path = None

if __name__ == "__main__":
    main()
