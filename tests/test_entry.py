import __spark_entry__ as entry


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "employee_ssn" in df.columns


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 200
