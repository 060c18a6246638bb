"""The checks declared for the staging models and the facts, in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cubewise.operators.quality import (
    Check,
    accepted_values_check,
    combine_reports,
    not_null_check,
    quality_report,
    unique_check,
)
from cubewise.schemas import ACCEPTED_YEARS

STG_NOT_NULL = ["statistic", "year", "month", "test_category", "test_centre_raw", "county", "unit"]
STG_COUNTY_NOT_NULL = ["statistic_label", "year", "month", "county", "driving_test_categories", "unit", "value"]
COUNTY_GRAIN = ["county", "test_category", "date_month"]
CENTRE_GRAIN = ["test_centre", "county", "test_category", "date_month"]

QUALITY_SUITE: dict[str, list[Check]] = {
    "stg_applications": [*not_null_check(*STG_NOT_NULL),
                         accepted_values_check("year", ACCEPTED_YEARS, severity="warn")],
    "stg_county": not_null_check(*STG_COUNTY_NOT_NULL),
    "stg_tests": not_null_check(*STG_NOT_NULL),
    "stg_tests_no_category": not_null_check(*[c for c in STG_NOT_NULL if c != "test_category"]),
    "county_fact": [*not_null_check("year", "county", "test_category", "date_month"),
                    unique_check(*COUNTY_GRAIN)],
    "centre_fact": [*not_null_check("county", "year", "pass_rate"),
                    unique_check(*CENTRE_GRAIN)],
}


def suite_report(tables: dict[str, DataFrame], weight: str | None = None) -> DataFrame:
    """The report over the given models (name in QUALITY_SUITE -> rows). Models with the
    column ``weight`` hold one row for so many equal ones."""
    return combine_reports([quality_report(name, df, QUALITY_SUITE[name], weight if weight in df.columns else None)
                            for name, df in tables.items()])
