"""Answers from the stored aggregate equal those of the fact, before and after refreshes."""

import datetime

from cubewise.operators import serving
from cubewise.plans.serving_store import Serving, refresh_serving, store_schema
from cubewise.session import scratch_path
from cubewise.streaming.months import NO_MONTH

SCHEMA = ("year string, month long, month_name string, date_month date, county string, test_centre string, test_category string, "
          "applications_received long, applicants_waiting long, tests_delivered long, pass_rate long, no_shows long")


def row(year, month, county, centre, category, *figures):
    date = datetime.date(int(year), month, 1) if year and month and 1 <= month <= 12 else None
    return (year, month, date and date.strftime("%B"), date, county, centre, category, *figures)


ROWS = [
    row("2020", 1, "Galway", "Tuam", "B", 5, 9, 3, 50, None), row("2020", 1, "Galway", "Tuam", "B", 7, None, 1, 80, 2),
    row("2020", 2, "Galway", "Clifden", "B", None, 4, None, 70, 1), row("2021", 1, "Cork", None, "C", 2, 4, 0, 10, 0),
    row("2021", 12, None, "Mallow", None, 1, 1, 6, None, 5), row("2021", 13, "Cork", "Mallow", "B", 8, 3, 2, 90, 1),
    row(None, None, "Cork", "Tuam", "C", 4, None, 4, 20, None),
]
FILTERS = [{}, {"year": "2021"}, {"month": [1, 12]}, {"year": ["2020", 2021], "month": 1, "category": "B"}, {"county": "Cork"},
           {"centre": ["Tuam"]}, {"year": "1999"}]


def rows(df):
    return sorted(map(str, df.collect()))


def same(spark, path, data):
    fact = spark.createDataFrame(data, SCHEMA)
    store = Serving(spark, path, store_schema(fact))
    for f in FILTERS:
        assert rows(store.scorecards(**f)) == rows(serving.scorecards(fact, **f)), f
        assert rows(store.yearly_rollup("county", **f)) == rows(serving.yearly_rollup(fact, "county", **f)), f
    for dims in (["test_category"], ["date_month"], ["county", "test_centre"]):
        assert rows(store.measure_by(dims, ["tests_delivered", "no_shows"])) == rows(serving.measure_by(fact, dims, ["tests_delivered", "no_shows"]))
    assert store.top_centres(n=2).collect() == serving.top_centres(fact, n=2).collect()
    return store


def test_answers_equal_the_facts_and_follow_refreshed_months(spark):
    path = scratch_path(spark, "serving")
    refresh_serving(spark.createDataFrame(ROWS, SCHEMA), path)
    held = same(spark, path, ROWS).store.months
    # January 2020 changes, December goes, rows without a month lose one.
    changed = [row("2020", 1, "Galway", "Tuam", "B", 1, 1, 1, 1, 1), *ROWS[2:4], ROWS[6]]
    refresh_serving(spark.createDataFrame(changed, SCHEMA), path, ["2020-01-01", "2021-12-01", NO_MONTH])
    now = same(spark, path, changed).store.months
    assert "2021-12-01" not in now and now["2020-02-01"] == held["2020-02-01"] and now["2020-01-01"] != held["2020-01-01"]


def test_a_year_filter_reads_its_months_only(spark):
    path = scratch_path(spark, "serving")
    fact = spark.createDataFrame(ROWS, SCHEMA)
    refresh_serving(fact, path)
    files = Serving(spark, path, store_schema(fact)).rows(year="2020").inputFiles()
    assert {f.split("period=")[1].split("/")[0] for f in files} == {"2020-01-01", "2020-02-01", NO_MONTH}


def test_an_empty_fact_has_empty_answers(spark):
    path = scratch_path(spark, "serving")
    fact = spark.createDataFrame([], SCHEMA)
    refresh_serving(fact, path)
    store = Serving(spark, path, store_schema(fact))
    assert store.scorecards().collect() == serving.scorecards(fact).collect() and not store.measure_by(["county"], ["no_shows"]).collect()
