import __spark_entry__ as E


def test_oracle_sql_holds_only_sql():
    sql = E.oracle_sql()
    assert [k for k, v in sql.items() if not isinstance(v, str)] == []
    assert set(sql) <= set(E.queries())
