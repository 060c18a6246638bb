"""Check results kept by month equal the checks over the whole table."""

import datetime

import pytest

from cubewise.operators.quality import accepted_values_check, not_null_check, quality_report, unique_check
from cubewise.session import scratch_path
from cubewise.streaming.months import NO_MONTH, MonthStore
from cubewise.streaming.quality_months import kept_report, refresh_checks

CHECKS = [*not_null_check("county"), accepted_values_check("year", ["2021"], severity="warn"), unique_check("county", "date_month")]
JAN, FEB = datetime.date(2021, 1, 1), datetime.date(2021, 2, 1)
ROWS = [("A", "2021", JAN), ("A", "2021", JAN), (None, "2021", JAN), ("A", "2020", FEB), ("B", None, FEB), ("A", "x", None), ("A", "x", None)]


def table(spark, rows):
    return spark.createDataFrame(rows, "county string, year string, date_month date")


def both(spark, path, rows):
    kept = sorted(map(tuple, kept_report(spark, path, "t", CHECKS).collect()))
    return kept, sorted(map(tuple, quality_report("t", table(spark, rows), CHECKS).collect()))


def test_kept_results_equal_the_whole_report_after_refreshes(spark):
    path = scratch_path(spark, "checks")
    refresh_checks(spark, path, table(spark, ROWS), CHECKS, "date_month")
    kept, whole = both(spark, path, ROWS)
    assert kept == whole
    # January mended, the rows without a month gone: only these months are counted again.
    held = MonthStore(spark, path).months["2021-02-01"]
    rows = [("A", "2021", JAN)] + ROWS[3:5]
    refresh_checks(spark, path, table(spark, rows), CHECKS, "date_month", ["2021-01-01", NO_MONTH])
    kept, whole = both(spark, path, rows)
    assert kept == whole and MonthStore(spark, path).months["2021-02-01"] == held
    assert NO_MONTH not in MonthStore(spark, path).months


def test_keys_without_the_month_are_refused(spark):
    with pytest.raises(ValueError, match="may span months"):
        refresh_checks(spark, scratch_path(spark, "checks"), table(spark, ROWS), [unique_check("county")], "date_month")
