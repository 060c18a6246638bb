"""Staging, pivot, full outer join and both facts on hand-written raw rows."""

import datetime as dt

from pyspark.sql import functions as F

from cubewise.operators.filters import drop_totals
from cubewise.operators.pivot import full_outer_on, pivot_measures
from cubewise.plans.facts import centre_fact, county_fact
from cubewise.plans.staging import stage_centre_stats, stage_county_stats
from cubewise.schemas import RAW_CENTRE_SCHEMA, RAW_COUNTY_SCHEMA

APPS = "Driving Test Applications Received"
WAIT = "Driving Test Applicants Waiting at Month End"
DELIV = "Driving Tests Delivered"
RATE = "Driving Test Pass Rate"


def api_rows(spark, rows):
    return spark.createDataFrame(
        [(s, m, cat, centre, "Number", v) for s, m, cat, centre, v in rows], RAW_CENTRE_SCHEMA)


def county_rows(spark, rows):
    return spark.createDataFrame(
        [(s, m, county, cat, "Number", v) for s, m, county, cat, v in rows], RAW_COUNTY_SCHEMA)


def test_stage_centre_stats_columns(spark):
    raw = api_rows(spark, [(APPS, "2021 January", "B", "Tuam, Co. Galway", 5)])
    stg = stage_centre_stats(raw)
    assert stg.columns == ["statistic", "year", "month", "test_category", "test_centre_raw", "county", "unit"]
    r = stg.collect()[0]
    assert (r.year, r.month, r.county, r.unit) == ("2021", "January", "Co. Galway", 5)
    no_cat = stage_centre_stats(raw.drop("driving_test_categories"), has_category=False)
    assert "test_category" not in no_cat.columns


def test_stage_county_stats(spark):
    raw = county_rows(spark, [(DELIV, "2021 March", "Co. Cork", "B", 3.0)])
    r = stage_county_stats(raw).collect()[0]
    assert (r.statistic_label, r.year, r.month, r.county, r.value) == (DELIV, "2021", "March", "Co. Cork", 3.0)


def test_drop_totals_sees_raw_county(spark):
    raw = api_rows(spark, [
        (APPS, "2021 January", "B", "All driving test centres", 1),   # national total
        (APPS, "2021 January", "All test categories", "A, Co. Cork", 1),  # category total
        (APPS, "2021 January", "B", "Finglas", 1),                    # no county
        (APPS, "2021 January", None, "A, Co. Cork", 1),               # NULL category
        (APPS, "2021 January", "B", "A, Co. Cork", 1),                # kept
    ])
    kept = drop_totals(stage_centre_stats(raw))
    assert kept.count() == 1


def test_pivot_max_sum_and_unknown_statistic(spark):
    df = spark.createDataFrame([
        ("k1", APPS, 5), ("k1", APPS, 9), ("k1", WAIT, 2),
        ("k2", "Some other statistic", 7),
    ], "k string, s string, v bigint")
    m = {APPS: "apps", WAIT: "wait"}
    mx = {r.k: (r.apps, r.wait) for r in pivot_measures(df, ["k"], "s", "v", m, "max").collect()}
    sm = {r.k: (r.apps, r.wait) for r in pivot_measures(df, ["k"], "s", "v", m, "sum").collect()}
    assert mx == {"k1": (9, 2), "k2": (None, None)}   # a non-matching group still yields a row
    assert sm == {"k1": (14, 2), "k2": (None, None)}


def test_pivot_max_ignores_duplicates(spark):
    base = [("k1", APPS, 5), ("k1", APPS, 9), ("k2", APPS, 1)]
    m = {APPS: "apps"}
    a = spark.createDataFrame(base, "k string, s string, v bigint")
    b = spark.createDataFrame(base + base, "k string, s string, v bigint")
    assert sorted(pivot_measures(a, ["k"], "s", "v", m).collect()) == \
        sorted(pivot_measures(b, ["k"], "s", "v", m).collect())


def test_full_outer_null_keys_never_match(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("only_a", 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10), (None, 20), ("only_b", 30)], "k string, b int")
    rows = sorted(full_outer_on(a, b, ["k"]).collect(), key=lambda r: (str(r.k), r.a or 0, r.b or 0))
    assert [(r.k, r.a, r.b) for r in rows] == [
        (None, None, 20), (None, 2, None), ("only_a", 3, None), ("only_b", None, 30), ("x", 1, 10)]


def _fact_inputs(spark):
    api = api_rows(spark, [
        (APPS, "2021 January", "B", "Tuam, Co. Galway", 5),
        (APPS, "2021 January", "B", "Athenry, Co. Galway", 9),    # two centres, one county
        (WAIT, "2021 Jan", "B", "Tuam, Co. Galway", 4),           # short month name
        (APPS, "2021 January", "B", "X, Co.Dublin", 1),           # no space after Co.
        (APPS, "2021 13", "B", "Tuam, Co. Galway", 1),            # bad month
        (APPS, "2021 February", "B", "Only, Co. Mayo", 2),        # application side only
    ])
    local = county_rows(spark, [
        (DELIV, "2021 January", "Co. Galway", "B", 30.0),
        (RATE, "2021 January", "Co. Galway", "B", 55.5),
        (DELIV, "2021 January", "Ireland", "B", 999.0),            # national total
        (DELIV, "2021 March", "Co. Kerry", "B", 7.0),              # county side only
    ])
    return stage_centre_stats(api), stage_county_stats(local)


def test_county_fact_semantics(spark):
    stg_api, stg_local = _fact_inputs(spark)
    fact = county_fact(stg_api, stg_local)
    assert fact.columns[:6] == ["year", "month", "month_name", "date_month", "county", "test_category"]
    collected = fact.collect()
    rows = {(r.county, r.year, r.month, r.date_month): r for r in collected}
    jan = dt.date(2021, 1, 1)
    galway = [r for r in collected if r.county == "Galway" and r.date_month == jan]
    # 'January' and 'Jan' stay separate groups with the same date
    assert len(galway) == 2
    full = [r for r in galway if r.applications_received is not None][0]
    assert full.applications_received == 9           # largest centre, not the total
    assert full.tests_delivered == 30.0 and full.pass_rate == 55.5
    assert full.month_name == "January"
    short = [r for r in galway if r.applications_received is None][0]
    assert short.applicants_waiting == 4 and short.tests_delivered is None
    assert ("Co.Dublin", "2021", 1, jan) in rows
    bad = [r for k, r in rows.items() if k[0] == "Galway" and k[3] is None]
    assert len(bad) == 1 and bad[0].month == 13 and bad[0].month_name is None
    assert rows[("Mayo", "2021", 2, dt.date(2021, 2, 1))].tests_delivered is None
    assert rows[("Kerry", "2021", 3, dt.date(2021, 3, 1))].applications_received is None
    assert not any(k[0] == "Ireland" for k in rows)


def test_county_fact_sum_option(spark):
    stg_api, stg_local = _fact_inputs(spark)
    fact = county_fact(stg_api, stg_local, agg="sum")
    r = fact.filter((F.col("county") == "Galway") & F.col("applications_received").isNotNull()
                    & (F.col("month") == 1)).collect()[0]
    assert r.applications_received == 14


def test_centre_fact_keeps_centres_apart(spark):
    stg_api, _ = _fact_inputs(spark)
    ro30 = stage_centre_stats(api_rows(spark, [
        (DELIV, "2021 January", "B", "Tuam, Co. Galway", 12),
        ("Driving Tests Not Conducted / Abandoned", "2021 January", "B", "Tuam, Co. Galway", 3),
    ]))
    fact = centre_fact(stg_api, ro30)
    assert "test_centre" in fact.columns
    tuam = fact.filter((F.col("test_centre") == "Tuam, Co. Galway") & (F.col("date_month") == dt.date(2021, 1, 1))
                       & F.col("applications_received").isNotNull()).collect()[0]
    assert (tuam.applications_received, tuam.tests_delivered, tuam.notconducted_or_abandoned) == (5, 12, 3)
