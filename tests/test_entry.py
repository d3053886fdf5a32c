import __spark_entry__ as e


def test_entry_and_registry_shapes(spark):
    df = e.entry(spark)
    assert df.count() > 0 and df.columns[-1] == "batchdate"
    assert set(e.oracle_sql()) - set(e.LLM_ORACLE) == set(e.queries()) - set(e.LLM_QUERIES)
    assert set(e.LLM_ORACLE) <= set(e.LLM_QUERIES)
