import pytest
from pyspark.sql import functions as F

from feedlake.functions import fill_empty_strings
from feedlake.operators import difference, mismatch_report, pair_on_keys, recon_mismatch, recon_new_records
from feedlake.plans import reconcile
from feedlake.sinks import create_feed_table, overwrite_raw
from feedlake.sources import scan_delimited, scan_json
from feedlake.spec import ReconSpec
from feedlake.workspace import new_dir, new_name
from tests.conftest import rows

S = "k int, x string, y double"


def test_set_difference_collapses_duplicates_and_matches_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b"), (2, "b"), (3, "c")], "k int, x string")
    right = spark.createDataFrame([(1, None)], "k int, x string")
    assert rows(difference(left, right)) == [(2, "b"), (3, "c")]


def test_mismatch_labels(spark):
    raw = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, None, 4.0)], S)
    src = spark.createDataFrame([(1, "a", 1.5), (2, "B", 2.5), (3, None, 3.0), (4, "d", 4.0), (9, "n", 9.0)], S)
    diff = difference(src, raw)
    rep = rows(mismatch_report(raw, diff, ["k"]))
    assert rep == [(1, "[y]"), (2, "[x, y]"), (3, "[]"), (4, "[]"), (9, "new record")]
    assert rows(recon_mismatch(raw, diff, ["K"])) == [(1, "[y]"), (2, "[x, y]"), (3, "[]"), (4, "[]")]
    assert rows(recon_new_records(diff, raw, ["k"])) == [(9, "new record")]


def test_duplicate_raw_keys_give_one_row_per_difference_row(spark):
    # key 1 is duplicated in raw: the flags of both raw rows are united, no pair explosion
    raw = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "z", 2.0)], S)
    src = spark.createDataFrame([(1, "a", 7.0), (1, "c", 1.0)], S)
    rep = rows(mismatch_report(raw, difference(src, raw), ["k"]))
    assert rep == [(1, "[x, y]"), (1, "[x]")]
    prof = pair_on_keys(raw, difference(src, raw), ["k"]).collect()
    assert {r["df_raw__rows"] for r in prof} == {2}


def test_null_key_is_always_a_new_record(spark):
    raw = spark.createDataFrame([(None, "a", 1.0)], S)
    src = spark.createDataFrame([(None, "b", 1.0)], S)
    assert rows(mismatch_report(raw, difference(src, raw), ["k"])) == [(None, "new record")]


def test_csv_oddities(spark):
    path = new_dir(spark, "odd_csv")
    spark.sparkContext.parallelize(["k|x|y", "1||2.5", "2|b|3.5|extra", "x|c|1.0"], 1).saveAsTextFile(path)
    df = scan_delimited(spark, path, spark.createDataFrame([], S).schema, "|")
    got = rows(df)
    # header line is data (uncastable int -> null), empty field -> null, extra field dropped
    assert (1, None, 2.5) in got and (2, "b", 3.5) in got and (None, "c", 1.0) in got and len(got) == 4
    assert rows(fill_empty_strings(df), "k", "x")[0:2] == [(1, ""), (2, "b")]
    with_header = scan_delimited(spark, path, spark.createDataFrame([], S).schema, "|", header=True)
    assert with_header.count() == 3


def _raw_table(spark, data):
    db = new_name("recon_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    name = f"{db}.raw"
    df = spark.createDataFrame(data, S + ", batchdate string")
    create_feed_table(spark, name, df.schema, new_dir(spark, "raw"))
    overwrite_raw(df, name)
    return name


def test_reconcile_writes_json_and_csv_reports(spark):
    name = _raw_table(spark, [(1, "a", 1.0, "2024-01-02"), (2, "b", 2.0, "2024-01-02"), (3, "c", 3.0, "2024-01-01")])
    src_path = new_dir(spark, "src")
    spark.createDataFrame([(1, "a", 1.0), (2, "x", 2.0), (5, "n", 5.0)], S).write.json(src_path)
    out = new_dir(spark, "recon_out")
    spec = ReconSpec(raw_table=name, primary_key=("K",), output_path=out, input_path=src_path, file_type="json")
    res = reconcile(spark, spec, "2024-01-02")
    assert res["raw_count"] == 2 and res["difference"] == 2
    diff = scan_json(spark, res["difference_path"], spark.createDataFrame([], S).schema)
    assert rows(diff) == [(2, "x", 2.0), (5, "n", 5.0)]
    info = scan_delimited(spark, res["info_path"], spark.createDataFrame([], "k int, column_name string").schema,
                          ",", header=True)
    assert rows(info) == [(2, "[x]"), (5, "new record")]


def test_reconcile_no_difference_writes_nothing(spark):
    name = _raw_table(spark, [(1, "a", 1.0, "2024-01-02")])
    src = new_dir(spark, "src")
    spark.createDataFrame([(1, "a", 1.0)], S).write.json(src)
    spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "o"), input_path=src,
                     file_type="json")
    res = reconcile(spark, spec, "2024-01-02")
    assert res["difference"] == 0 and res["difference_path"] is None


def test_unknown_source_type_raises(spark):
    name = _raw_table(spark, [(1, "a", 1.0, "2024-01-02")])
    spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "o"), input_path="x",
                     file_type="xml")
    with pytest.raises(ValueError):
        reconcile(spark, spec, "2024-01-02")


def test_hot_key_stays_linear(spark):
    # one key holds most rows on both sides: the report has one row per difference row, not all pairs
    raw = spark.range(0, 20000).selectExpr("0 AS k", "CAST(id AS STRING) AS x", "CAST(id AS DOUBLE) AS y")
    src = spark.range(0, 3000).selectExpr("0 AS k", "CAST(id AS STRING) AS x", "CAST(-1 AS DOUBLE) AS y")
    diff = difference(src, raw)
    rep = mismatch_report(raw, diff, ["k"])
    assert rep.count() == 3000
    assert {r["column_name"] for r in rep.collect()} == {"[x, y]"}


def test_null_safe_flags_changes_to_and_from_null(spark):
    raw = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", None)], S)
    src = spark.createDataFrame([(1, None, 1.0), (2, "b", 2.0), (3, "c", 3.0)], S)
    diff = difference(src, raw)
    assert rows(mismatch_report(raw, diff, ["k"])) == [(1, "[]"), (2, "[]"), (3, "[]")]
    assert rows(mismatch_report(raw, diff, ["k"], null_safe=True)) == [(1, "[x]"), (2, "[x]"), (3, "[y]")]


def test_table_source_is_aligned_by_name(spark):
    name = _raw_table(spark, [(1, "a", 1.0, "2024-01-02"), (2, "b", 2.0, "2024-01-02")])
    db = name.split(".")[0]
    src_path = new_dir(spark, "src_table")
    # same columns, other order, one changed value
    spark.createDataFrame([(1.0, "a", 1), (9.0, "b", 2)], "y double, x string, k int").write.parquet(src_path)
    spark.catalog.createTable(f"{db}.src", path=src_path, source="parquet")
    spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "o"), input_table=f"{db}.src")
    res = reconcile(spark, spec, "2024-01-02")
    assert res["difference"] == 1
    info = scan_delimited(spark, res["info_path"], spark.createDataFrame([], "k int, column_name string").schema,
                          ",", header=True)
    assert rows(info) == [(2, "[y]")]


def test_complex_columns_are_compared(spark):
    schema = "k int, m map<string,int>, s struct<a:int, n:map<string,int>>, arr array<int>"
    raw = spark.createDataFrame([(1, {"a": 1}, (1, {"x": 1}), [1, 2]), (2, {"b": 2}, (2, {"y": 2}), [3])], schema)
    src = spark.createDataFrame([(1, {"a": 9}, (1, {"x": 1}), [1, 2]), (2, {"b": 2}, (2, {"y": 5}), [4])], schema)
    # EXCEPT rejects map columns, so the differing rows are passed directly
    rep = rows(mismatch_report(raw, src, ["k"]))
    assert rep == [(1, "[m]"), (2, "[s, arr]")]


def test_profile_is_exact_when_aqe_splits_a_hot_raw_key(spark):
    from pyspark.sql import functions as F

    from feedlake.operators import key_profile

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        raw = spark.range(0, 60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(8)).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
        diff = spark.range(0, 60000, 2).select(F.col("id").alias("k"), F.lit(-1).alias("x"))
        prof = {r["k"]: r for r in key_profile(raw, diff, ["k"], ["x"]).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # key 8 holds every id divisible by 3 plus id 8 itself
    assert prof[8]["df_raw__rows"] == 20001 and prof[8]["df_raw_x_min"] == 0 and prof[8]["df_raw_x_max"] == 59997
    assert set(prof) == {k for k in range(0, 60000, 2) if k % 3 != 0}


def test_recon_spec_from_string_settings():
    spec = ReconSpec.from_options(
        {"primary_key": "ID, Part", "file_extension": "csv", "delimiter": "|", "input_table": "None",
         "mapping_details": '{"a": "b"}', "drop_columns": ""},
        raw_table="db.raw", output_path="/out", input_path="/in", do_column_check="0")
    assert spec.primary_key == ("ID", "Part") and spec.input_table is None and spec.delimiter == "|"
    assert spec.mapping == {"a": "b"} and spec.drop_columns == () and spec.do_column_check is False


@pytest.mark.parametrize("null_safe", [False, True])
def test_keyed_reconcile_equals_except_path_for_unique_keys(spark, null_safe):
    import random

    from feedlake.operators import keyed_difference_report

    rnd = random.Random(7 + null_safe)
    vals = [None, "a", "b"]
    raw_rows = [(k, rnd.choice(vals), rnd.choice([None, 1.0, 2.0])) for k in [None] + list(range(40))]
    src_rows = [(k, rnd.choice(vals), rnd.choice([None, 1.0, 2.0])) for k in [None] + list(range(20, 60))]
    raw = spark.createDataFrame(raw_rows, S)
    src = spark.createDataFrame(src_rows, S)
    d = difference(src, raw)
    keyed = keyed_difference_report(src, raw, ["k"], null_safe)
    assert rows(keyed.drop("column_name")) == rows(d)
    assert rows(keyed.select("k", "column_name")) == rows(mismatch_report(raw, d, ["k"], null_safe))


def test_reconcile_keyed_mode_writes_the_same_reports(spark):
    name = _raw_table(spark, [(1, "a", 1.0, "2024-01-02"), (2, "b", 2.0, "2024-01-02"), (3, None, 3.0, "2024-01-02")])
    src_path = new_dir(spark, "src")
    spark.createDataFrame([(1, "a", 1.0), (2, "x", 2.0), (3, "c", 3.0), (5, "n", 5.0)], S).write.json(src_path)
    results = []
    for keyed in (False, True):
        spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "o"), input_path=src_path,
                         file_type="json", keyed=keyed)
        res = reconcile(spark, spec, "2024-01-02")
        diff = rows(scan_json(spark, res["difference_path"], spark.createDataFrame([], S).schema))
        info = rows(scan_delimited(spark, res["info_path"],
                                   spark.createDataFrame([], "k int, column_name string").schema, ",", header=True))
        results.append((res["difference"], diff, info))
    assert results[0] == results[1]
    assert results[1][2] == [(2, "[x]"), (3, "[]"), (5, "new record")]


def test_keyed_mode_refuses_duplicate_keys(spark):
    name = _raw_table(spark, [(1, "a", 1.0, "2024-01-02"), (1, "b", 2.0, "2024-01-02")])
    src = new_dir(spark, "src")
    spark.createDataFrame([(1, "c", 1.0)], S).write.json(src)
    spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "o"), input_path=src,
                     file_type="json", keyed=True)
    with pytest.raises(ValueError):
        reconcile(spark, spec, "2024-01-02")


@pytest.mark.parametrize("null_safe", [False, True])
def test_keyed_mode_takes_a_source_whose_keys_repeat(spark, null_safe):
    # key 2: an unchanged row and a changed one; key 3: a changed row twice; key 9 and the null key: new, twice
    name = _raw_table(spark, [(k, "a", None if k == 4 else 1.0, "2024-01-02") for k in (1, 2, 3, 4)])
    src = [(1, "a", 1.0), (1, "a", 1.0), (2, "a", 1.0), (2, "b", 1.0), (3, "b", 2.0), (3, "b", 2.0), (3, "a", 3.0), (4, "a", 5.0)]
    src += [(9, "n", 1.0), (9, "n", 1.0), (9, "m", 1.0), (None, "n", 1.0), (None, "n", 1.0)]
    src_path = new_dir(spark, "src")
    spark.createDataFrame(src, S).write.json(src_path)
    results = []
    for keyed in (False, True):
        spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "o"), input_path=src_path,
                         file_type="json", keyed=keyed, null_safe=null_safe)
        res = reconcile(spark, spec, "2024-01-02")
        diff = rows(scan_json(spark, res["difference_path"], spark.createDataFrame([], S).schema))
        info = rows(scan_delimited(spark, res["info_path"],
                                   spark.createDataFrame([], "k int, column_name string").schema, ",", header=True))
        results.append((res["difference"], diff, info))
    assert results[0] == results[1]
    assert results[1][0] == 7
    assert results[1][2] == [(2, "[x]"), (3, "[x, y]"), (3, "[y]"), (4, "[y]" if null_safe else "[]"), (9, "new record"),
                             (9, "new record"), (None, "new record")]


def test_reconcile_with_mapping_and_drop_list(spark):
    # raw stores `x` as `legacy_x` and has a load timestamp column the source does not carry
    db = new_name("recon_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    df = spark.createDataFrame([(1, "a", 1.0, "t1", "2024-01-02"), (2, "b", 2.0, "t2", "2024-01-02")],
                               "k int, legacy_x string, y double, loaded string, batchdate string")
    create_feed_table(spark, f"{db}.raw", df.schema, new_dir(spark, "raw"))
    overwrite_raw(df, f"{db}.raw")
    src = new_dir(spark, "src")
    spark.createDataFrame([(1, "a", 1.0, "zz"), (2, "B", 2.0, "zz")], "k int, x string, y double, loaded string") \
        .write.json(src)
    spec = ReconSpec.from_options(
        {"primary_key": "k", "file_extension": "json", "delimiter": ",", "input_table": "None",
         "mapping_details": '{"legacy_x": "x"}', "drop_columns": "loaded"},
        raw_table=f"{db}.raw", output_path=new_dir(spark, "o"), input_path=src)
    res = reconcile(spark, spec, "2024-01-02")
    assert res["difference"] == 1
    info = scan_delimited(spark, res["info_path"], spark.createDataFrame([], "k int, column_name string").schema,
                          ",", header=True)
    assert rows(info) == [(2, "[x]")]


def test_fill_both_removes_null_string_differences(spark):
    name = _raw_table(spark, [(1, None, 1.0, "2024-01-02"), (2, "b", 2.0, "2024-01-02")])
    src = new_dir(spark, "src_csv")
    spark.createDataFrame([(1, None, 1.0), (2, "b", 2.0)], S).write.option("sep", "|").csv(src)
    base = dict(raw_table=name, primary_key=("k",), input_path=src, file_type="csv", delimiter="|")
    quirk = reconcile(spark, ReconSpec(output_path=new_dir(spark, "o"), **base), "2024-01-02")
    fixed = reconcile(spark, ReconSpec(output_path=new_dir(spark, "o"), fill_both=True, **base), "2024-01-02")
    assert quirk["difference"] == 1 and fixed["difference"] == 0


def test_small_tasks_bound_what_a_task_reads_and_keep_the_settings(spark):
    from feedlake.workspace import materialize, small_tasks

    raw = spark.range(400_000).select("id", (F.col("id") % 7).alias("v"))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    with pytest.raises(RuntimeError), small_tasks(spark, 10):
        raise RuntimeError
    with small_tasks(spark, 4_000_000):
        assert [spark.conf.get(k) for k in keys] == ["8388608b", "8388608b", "40"]
        out = materialize(difference(raw, raw.where("id % 4 = 0")), "small")
    assert [spark.conf.get(k, None) for k in keys] == before
    assert out.count() == 300_000


def test_union_all_shuffles_into_more_partitions_as_orders_grow(spark, tmp_path, monkeypatch):
    from feedlake import registry, workspace

    o = spark.range(3000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                                 F.lit(1.5).alias("o_totalprice"), F.lit(0).cast("timestamp").alias("o_orderdate"), F.lit("LOW").alias("o_orderpriority"))
    o.write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(workspace, "TASK_ROWS", 100)
    seen = []
    keep = registry.materialize
    monkeypatch.setattr(registry, "materialize", lambda df, label: (seen.append(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")), keep(df, label))[1])
    got = rows(registry.q_union_all(spark, str(tmp_path)))
    assert seen == ["60", "60"]  # 6,000 rows in 100 each, for the difference and for the comparison
    raw = spark.read.parquet(f"{tmp_path}/orders.parquet")
    assert got == rows(mismatch_report(raw, registry._diff(spark, str(tmp_path)), ["o_orderkey"]))
