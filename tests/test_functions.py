"""Scalar column functions on hand-written values (FN-1 .. FN-11)."""

import datetime as dt

from pyspark.sql import functions as F

from cubewise.functions import (
    county_from_centre,
    month_name,
    month_number,
    month_start,
    period_month,
    period_year,
    strip_county_prefix,
)


def one_col(spark, values, expr, name="x", type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} {type_}")
    return [r[0] for r in df.select(expr).collect()]


def test_period_split_and_missing_space(spark):
    vals = ["2021 January", "2021M01", None, "2021 jan extra"]
    assert one_col(spark, vals, period_year("x")) == ["2021", "2021M01", None, "2021"]
    # a label without a space gives NULL, not a failed job
    assert one_col(spark, vals, period_month("x")) == ["January", None, None, "jan"]


def test_county_from_centre(spark):
    vals = ["Tuam, Co. Galway", "All driving test centres", "Finglas", "X, Co.Dublin",
            "X, Co. Dún L", None, "all driving test centres"]
    got = one_col(spark, vals, county_from_centre("x"))
    assert got == ["Co. Galway", "Ireland", None, "Co.Dublin", "Co. D", None, None]


def test_strip_county_prefix(spark):
    vals = ["Co. Galway", "Co.Dublin", "Co.  Cork ", "Ireland", "\tCo. Mayo", None, "Co. \tKerry\n"]
    got = one_col(spark, vals, strip_county_prefix("x"))
    # the prefix needs whitespace after it; edge whitespace of any kind is trimmed
    assert got == ["Galway", "Co.Dublin", "Cork", "Ireland", "Co. Mayo", None, "Kerry"]


def test_month_number(spark):
    vals = ["jan", "January", "JANUARY", "1", "01", "may", "Sept", "13", "xyz", None, "december"]
    got = one_col(spark, vals, month_number("x"))
    assert got == [1, 1, 1, 1, 1, 5, None, 13, None, None, 12]


def test_month_start_and_name(spark):
    df = spark.createDataFrame([("2021", 1), ("2021", 12), ("2021", 13), ("2021", None), (None, 3),
                                ("2021M01", 2), ("2021", 0)], "y string, m bigint")
    rows = df.select(month_start("y", "m").alias("d")).select("d", month_name("d").alias("n")).collect()
    assert [r.d for r in rows] == [dt.date(2021, 1, 1), dt.date(2021, 12, 1), None, None, None, None, None]
    assert [r.n for r in rows] == ["January", "December", None, None, None, None, None]


def test_month_name_is_not_constant(spark):
    # every valid month gets its own name (not the first month for all)
    df = spark.range(1, 13).select(month_start(F.lit("2022"), F.col("id")).alias("d"))
    names = [r[0] for r in df.select(month_name("d")).collect()]
    assert len(set(names)) == 12
