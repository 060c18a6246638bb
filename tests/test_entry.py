"""Driver contract: entry smoke run and registry consistency."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:6] == ["year", "month", "month_name", "date_month", "county", "test_category"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30
    without_sql = {"preview", "pipeline"} | {n for n in q if n.startswith("op")}
    assert set(q) - set(o) <= without_sql
