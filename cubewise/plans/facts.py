"""Wide monthly fact tables at county and at test-centre grain.

Plan shape (both facts): filter raw rows -> partial/final hash aggregate on
the grain keys -> full outer sort-merge join on the *same* keys -> derive
month number, name and date after the join. Because aggregate keys equal
join keys, each side is shuffled exactly once (two exchanges in total).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.functions import month_name, month_number, month_start, strip_county_prefix
from cubewise.operators.filters import apply_filters, drop_totals
from cubewise.operators.pivot import full_outer_on, pivot_measures
from cubewise.schemas import (
    APPLICATION_MEASURES,
    CENTRE_KEYS,
    CENTRE_TEST_MEASURES,
    COUNTY_KEYS,
    COUNTY_TEST_MEASURES,
)


def clean_centre_rows(stg: DataFrame, keep_centre: bool = False) -> DataFrame:
    """Staged centre rows -> (year, month, county, [test_centre], test_category,
    statistic, stat_value). Totals are dropped on the raw county first."""
    required = ["test_centre_raw"] if keep_centre else []
    kept = drop_totals(stg, "county", "test_category", required)
    cols = [F.col("year"), F.col("month"), strip_county_prefix("county").alias("county")]
    if keep_centre:
        cols.append(F.col("test_centre_raw").alias("test_centre"))
    cols += [F.col("test_category"), F.col("statistic"), F.col("unit").alias("stat_value")]
    return kept.select(*cols)


def clean_county_rows(stg_local: DataFrame) -> DataFrame:
    """Staged county rows -> (year, month, county, test_category,
    statistic_label, stat_value)."""
    kept = drop_totals(stg_local, "county", "driving_test_categories")
    return kept.select(
        F.col("year"), F.col("month"), strip_county_prefix("county").alias("county"),
        F.col("driving_test_categories").alias("test_category"),
        F.col("statistic_label"), F.col("value").try_cast("double").alias("stat_value"),
    )


def _calendar_columns() -> list:
    """month (number), month_name, date_month from the joined raw year/month.

    The raw month text stays the group and join key; it is normalised only
    here, after the join, so that differently spelt months stay apart.
    """
    m = month_number("month")
    d = month_start("year", m)
    return [F.col("year"), m.alias("month"), month_name(d).alias("month_name"), d.alias("date_month")]


def _only(rows: DataFrame, filters: dict) -> DataFrame:
    """Dashboard filters on one side's rows. They name grain keys (the month by
    its number), which both sides share, so filtering each side before its pivot
    gives the same fact as filtering the joined one."""
    month = filters.get("month")
    if month is not None:
        values = list(month) if isinstance(month, (list, tuple, set, frozenset)) else [month]
        rows = rows.filter(month_number("month").isin(values))
    return apply_filters(rows, **{k: v for k, v in filters.items() if k != "month"})


def county_fact(stg_api: DataFrame, stg_local: DataFrame, agg: str = "max", **filters) -> DataFrame:
    """Applications (centre rows folded to county) joined with county test
    statistics. With ``agg='max'`` a county figure is its largest centre's.
    ``filters`` (county, year, month, category) restrict the fact; they run
    below the join."""
    apps = pivot_measures(_only(clean_centre_rows(stg_api), filters), COUNTY_KEYS, "statistic", "stat_value",
                          APPLICATION_MEASURES, agg)
    tests = pivot_measures(_only(clean_county_rows(stg_local), filters), COUNTY_KEYS, "statistic_label", "stat_value",
                           COUNTY_TEST_MEASURES, agg)
    joined = full_outer_on(apps, tests, COUNTY_KEYS)
    return joined.select(
        *_calendar_columns(), F.col("county"), F.col("test_category"),
        *[F.col(c) for c in APPLICATION_MEASURES.values()],
        *[F.col(c) for c in COUNTY_TEST_MEASURES.values()],
    )


def centre_fact(stg_api: DataFrame, stg_ro30: DataFrame, agg: str = "max", **filters) -> DataFrame:
    """Applications and tests per test centre, month and category; ``filters``
    (county, year, month, category, centre) run below the join."""
    apps = pivot_measures(_only(clean_centre_rows(stg_api, keep_centre=True), filters), CENTRE_KEYS, "statistic",
                          "stat_value", APPLICATION_MEASURES, agg)
    tests = pivot_measures(_only(clean_centre_rows(stg_ro30, keep_centre=True), filters), CENTRE_KEYS, "statistic",
                           "stat_value", CENTRE_TEST_MEASURES, agg)
    joined = full_outer_on(apps, tests, CENTRE_KEYS)
    return joined.select(
        *_calendar_columns(), F.col("county"), F.col("test_centre"), F.col("test_category"),
        *[F.col(c) for c in APPLICATION_MEASURES.values()],
        *[F.col(c) for c in CENTRE_TEST_MEASURES.values()],
    )
