import __spark_entry__ as contract


def test_names_and_twins():
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 40


def test_entry(spark):
    hits = contract.entry(spark)
    assert hits.columns == ["query_id", "rank", "doc_id", "title", "genre", "score"]
    assert hits.count() > 0
