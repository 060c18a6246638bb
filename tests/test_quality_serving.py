"""Data-quality checks, dashboard queries and the incremental stream."""

import datetime as dt

from pyspark.sql import functions as F

import pytest

from cubewise.operators.filters import apply_filters
from cubewise.operators.quality import (
    accepted_values,
    accepted_values_check,
    not_null,
    not_null_check,
    quality_report,
    unique,
    unique_check,
)
from cubewise.operators.serving import measure_by, scorecards, top_centres, yearly_rollup
from cubewise.plans.staging import stage_centre_stats
from cubewise.schemas import LANDING_CENTRE_SCHEMA
from cubewise.session import scratch_path
from cubewise.sinks.files import land_csv
from cubewise.streaming.incremental import start_incremental

FACT_SCHEMA = ("year string, month bigint, date_month date, county string, test_centre string, "
               "test_category string, applications_received bigint, applicants_waiting bigint, "
               "tests_delivered bigint, pass_rate bigint")


def fact(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 2, 1)
    return spark.createDataFrame([
        ("2021", 1, d1, "Cork", "A", "B", 10, 5, 100, 50),
        ("2021", 1, d1, "Cork", "B", "B", 20, 1, 300, 70),
        ("2021", 2, d2, "Kerry", "C", "C", None, 3, None, None),
        ("2022", 2, None, "Kerry", "D", "B", 5, None, 10, 40),
    ], FACT_SCHEMA)


def test_not_null_accepted_unique(spark):
    df = spark.createDataFrame([("a", "2021"), (None, "2017"), ("a", None), ("b", "2021")], "k string, y string")
    nn = not_null(df, ["k", "y"]).collect()
    assert sorted(r.null_columns for r in nn) == ["k", "y"]
    assert [r.y for r in accepted_values(df, "y", ["2021"]).collect()] == ["2017"]
    u = unique(df, ["k", "y"]).collect()
    assert [(r.unique_key, r.n_records) for r in u] == [("a-2021", 1)] or u == []
    dup = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("b", None)], "k string, y string")
    assert [(r.unique_key, r.n_records) for r in unique(dup, ["k", "y"]).collect()] == [("a-1", 2)]


def test_quality_report(spark):
    df = spark.createDataFrame([("a", "2021"), (None, "2017"), ("a", "2021")], "k string, y string")
    checks = [*not_null_check("k", "y"), accepted_values_check("y", ["2021"], severity="warn"),
              unique_check("k", "y")]
    rep = {r.check_name: (r.failing_rows, r.status) for r in quality_report("t", df, checks).collect()}
    assert rep == {"not_null_k": (1, "fail"), "not_null_y": (0, "pass"),
                   "accepted_values_y": (1, "warn"), "unique_k_y": (1, "fail")}


def test_filters_and_scorecards(spark):
    f = fact(spark)
    assert apply_filters(f, county="Cork", year=2021, month=[1], category="B").count() == 2
    r = scorecards(f, year="2021").collect()[0]
    assert (r.tests_delivered, r.applications_received) == (400, 30)
    assert r.avg_pass_rate == 60.0
    assert r.weighted_pass_rate == (50 * 100 + 70 * 300) / 400


def test_measure_by_and_top(spark):
    f = fact(spark)
    by = {r.county: (r.applications_received, r.tests_delivered)
          for r in measure_by(f, ["county"], ["applications_received", "tests_delivered"]).collect()}
    assert by == {"Cork": (30, 400), "Kerry": (5, 10)}
    top = [(r.test_centre, r.applicants_waiting) for r in top_centres(f, n=3).collect()]
    assert top == [("B", 1), ("C", 3), ("A", 5)]            # NULL total sorts last, cut at n
    assert top_centres(f, n=10).count() == 4


def test_yearly_rollup_with_population(spark):
    pop = spark.createDataFrame([("Cork", 1000)], "county string, population bigint")
    rows = {(r.county, r.year): r for r in yearly_rollup(fact(spark), "county", pop).collect()}
    cork = rows[("Cork", "2021")]
    assert cork.tests_conducted == 400 and cork.tests_per_capita == 0.4
    assert rows[("Kerry", "2022")].tests_per_capita is None


def test_incremental_refresh_equals_batch(spark):
    from cubewise.queries import centre_applications_pivot

    rows = [("Driving Test Applications Received", m, "B", c, "Number", v)
            for m, c, v in [("2021 January", "A, Co. X", 1), ("2021 January", "B, Co. X", 2),
                            ("2021 February", "A, Co. X", 3), ("2021 January", "A, Co. X", 7)]]
    landing, state, out, ckpt = (scratch_path(spark, n) for n in ("l", "s", "f", "c"))
    schema = ("year string, month string, county string, test_centre string, test_category string, "
              "applications_received bigint, applicants_waiting bigint, applicants_scheduled bigint, "
              "applicants_paused bigint, applicants_not_eligible bigint, period date")
    for batch in (rows[:3], rows[3:]):
        land_csv(spark.createDataFrame(batch, LANDING_CENTRE_SCHEMA), landing)
        start_incremental(spark, landing, LANDING_CENTRE_SCHEMA, state, out, ckpt,
                          centre_applications_pivot).awaitTermination()
    got = {(r.month, r.test_centre): r.applications_received
           for r in spark.read.schema(schema).parquet(out).collect()}
    assert got == {("January", "A, Co. X"): 7, ("January", "B, Co. X"): 2, ("February", "A, Co. X"): 3}
    raw = spark.createDataFrame(rows, LANDING_CENTRE_SCHEMA).toDF(
        "statistic", "month", "driving_test_categories", "driving_test_centre", "unit", "value")
    batch = centre_applications_pivot(stage_centre_stats(raw))
    assert batch.count() == len(got)
    with pytest.raises(ValueError, match="another checkpoint"):
        start_incremental(spark, landing, LANDING_CENTRE_SCHEMA, state, out, scratch_path(spark, "c"),
                          centre_applications_pivot)


def test_serving_options(spark):
    f = fact(spark)
    assert apply_filters(f, centre=["A", "C"]).count() == 2
    assert apply_filters(f).count() == 4
    top = [(r.test_centre, r.applications_received)
           for r in top_centres(f, "applications_received", n=2, ascending=False).collect()]
    assert top == [("B", 20), ("A", 10)]
    pop = spark.createDataFrame([("Kerry", "2021", 100), ("Kerry", "2022", 50)],
                                "county string, year string, population bigint")
    rows = {(r.county, r.year): r.tests_per_capita for r in yearly_rollup(f, "county", pop).collect()}
    assert rows[("Kerry", "2022")] == 0.2 and rows[("Kerry", "2021")] is None and rows[("Cork", "2021")] is None


def test_build_warehouse(spark):
    from cubewise.plans.warehouse import build_warehouse
    from cubewise.schemas import LANDING_COUNTY_SCHEMA

    apps = [("Driving Test Applications Received", "2021 January", "B", "Tuam, Co. Galway", "Number", 5)]
    tests_ = [("Driving Tests Delivered", "2021 January", "B", "Tuam, Co. Galway", "Number", 9)]
    county = [("Driving Tests Delivered", "2021 January", "Co. Galway", "B", "Number", 30.0)]
    paths = {n: scratch_path(spark, f"t_wh_{n}") for n in ("a", "t", "c")}
    land_csv(spark.createDataFrame(apps, LANDING_CENTRE_SCHEMA), paths["a"])
    land_csv(spark.createDataFrame(tests_, LANDING_CENTRE_SCHEMA), paths["t"])
    land_csv(spark.createDataFrame(county, LANDING_COUNTY_SCHEMA), paths["c"])
    wh = build_warehouse(spark, paths["a"], paths["t"], paths["c"], scratch_path(spark, "t_wh"))
    cf = wh.county_fact.collect()
    assert len(cf) == 1 and cf[0].applications_received == 5 and cf[0].tests_delivered == 30.0
    tf = wh.centre_fact.collect()
    assert tf[0].tests_delivered == 9 and tf[0].test_centre == "Tuam, Co. Galway"
    report = {(r.table_name, r.check_name): r.status for r in wh.report.collect()}
    assert report[("county_fact", "unique_county_test_category_date_month")] == "pass"
    assert report[("centre_fact", "not_null_pass_rate")] == "fail"   # NULL by construction
