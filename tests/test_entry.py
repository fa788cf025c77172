import __spark_entry__


def test_every_sql_belongs_to_a_query():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 50 and all(map(callable, queries.values()))
