from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.operators import difference, incremental_snapshot, latest_batch

keys = st.lists(st.integers(min_value=0, max_value=20), max_size=12)


@settings(max_examples=8, deadline=None)
@given(hist_keys=keys, delta_keys=keys)
def test_snapshot_keys_are_delta_union_latest(spark, hist_keys, delta_keys):
    hist = spark.createDataFrame([(k, "2024-01-01") for k in hist_keys], "k int, batchdate string")
    delta = spark.createDataFrame([(k,) for k in delta_keys], "k int")
    snap = incremental_snapshot(delta, hist, ["k"], "2024-01-02")
    got = sorted(r["k"] for r in snap.collect())
    want = sorted(delta_keys + [k for k in hist_keys if k not in set(delta_keys)])
    assert got == want
    # an empty delta gives back the latest batch
    empty = spark.createDataFrame([], "k int")
    assert sorted(r["k"] for r in incremental_snapshot(empty, hist, ["k"], "2024-01-02").collect()) == sorted(
        r["k"] for r in latest_batch(hist).collect()
    )


@settings(max_examples=5, deadline=None)
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from("ab"))), max_size=10))
def test_difference_with_itself_is_empty(spark, vals):
    df = spark.createDataFrame(vals, "a int, b string")
    assert difference(df, df).count() == 0


rows_st = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.sampled_from("abc"))), max_size=10)


@settings(max_examples=6, deadline=None)
@given(raw_rows=rows_st, src_rows=rows_st)
def test_every_difference_row_is_reported_once(spark, raw_rows, src_rows):
    from feedlake.operators import mismatch_report

    raw = spark.createDataFrame(raw_rows, "k int, x string")
    src = spark.createDataFrame(src_rows, "k int, x string")
    diff = difference(src, raw)
    report = mismatch_report(raw, diff, ["k"])
    assert sorted(r["k"] for r in report.collect()) == sorted(r["k"] for r in diff.collect())
    raw_keys = {k for k, _ in raw_rows}
    for r in report.collect():
        assert (r["column_name"] == "new record") == (r["k"] not in raw_keys)


key_part = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=8, deadline=None)
@given(
    hist=st.lists(st.tuples(key_part, key_part, st.sampled_from(["2024-01-01", "2023-12-01"])), max_size=10),
    delta=st.lists(st.tuples(key_part, key_part), max_size=8),
)
def test_snapshot_matches_a_python_model(spark, hist, delta):
    """Composite keys with nulls: carried = latest-batch rows whose (a, b) equals no delta key (null never equal)."""
    h = spark.createDataFrame([(a, b, f"h{i}", d) for i, (a, b, d) in enumerate(hist)],
                              "a int, b int, v string, batchdate string")
    dl = spark.createDataFrame([(a, b, f"d{i}") for i, (a, b) in enumerate(delta)], "a int, b int, v string")
    got = sorted(r["v"] for r in incremental_snapshot(dl, h, ["a", "b"], "2024-01-02").collect())
    latest = max((d for _, _, d in hist), default=None)
    dkeys = {(a, b) for a, b in delta if a is not None and b is not None}
    carried = [f"h{i}" for i, (a, b, d) in enumerate(hist)
               if d == latest and (a is None or b is None or (a, b) not in dkeys)]
    assert got == sorted([f"d{i}" for i in range(len(delta))] + carried)


val = st.one_of(st.none(), st.sampled_from("ab"))


@settings(max_examples=6, deadline=None)
@given(
    raw_vals=st.dictionaries(st.one_of(st.none(), st.integers(0, 6)), val, max_size=7),
    src_vals=st.dictionaries(st.one_of(st.none(), st.integers(0, 6)), val, max_size=7),
    null_safe=st.booleans(),
)
def test_keyed_mode_equals_except_path(spark, raw_vals, src_vals, null_safe):
    from feedlake.operators import keyed_difference_report, mismatch_report

    raw = spark.createDataFrame(list(raw_vals.items()), "k int, x string")
    src = spark.createDataFrame(list(src_vals.items()), "k int, x string")
    d = difference(src, raw)
    keyed = keyed_difference_report(src, raw, ["k"], null_safe)

    def srt(rs):
        return sorted((tuple(r) for r in rs), key=repr)

    assert srt(keyed.drop("column_name").collect()) == srt(d.collect())
    assert srt(keyed.select("k", "column_name").collect()) == srt(mismatch_report(raw, d, ["k"], null_safe).collect())
