import __spark_entry__ as e


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(e.oracle_sql()) <= set(e.queries())
