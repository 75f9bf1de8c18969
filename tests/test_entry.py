import __spark_entry__ as entry


def test_every_query_is_callable_and_every_sql_has_a_query():
    found = entry.queries()
    assert found and all(callable(f) for f in found.values())
    assert set(entry.oracle_sql()) <= set(found)


def test_flagship(spark):
    df = entry.entry(spark)
    assert {"customer_id", "order_count", "consents_marketing"} <= set(df.columns) and df.count() > 0
