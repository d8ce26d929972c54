"""Driver contract: entry runs on sf0.001; every query has a name-aligned oracle."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["event_type", "expected", "loaded", "missing"]
    assert len(rows) > 0 and all(r["missing"] >= 0 for r in rows)


def test_every_query_has_oracle_or_is_listed():
    rows_only = {"estimated_count"}
    assert set(E.queries()) - set(E.oracle_sql()) - set(E.CORPUS) == rows_only
    assert set(E.oracle_sql()) <= set(E.queries())
