"""The registry: every query has a name of its own, and SQL belongs to a query."""

import __spark_entry__ as entry


def test_registry():
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and len(names) >= 80


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and rows.columns == ["pair_sha256", "pool_record_id", "domain", "n_rows", "sources"]
