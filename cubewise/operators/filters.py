"""Row filters: total-row removal and dashboard filters."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubewise.schemas import EXCLUDED_CATEGORIES, EXCLUDED_COUNTIES


def not_in_lower(c: Column, values: Iterable[str]) -> Column:
    """``lower(c) NOT IN (values) AND c IS NOT NULL``."""
    return ~F.lower(c).isin(list(values)) & c.isNotNull()


def drop_totals(df: DataFrame, county_col: str = "county", category_col: str | None = "test_category",
                required: Iterable[str] = ()) -> DataFrame:
    """Remove national-total and all-category rows and rows missing a key.

    Must run on the *raw* county label (before any cleaning projection), as
    the national total is recognised by its raw spelling.
    """
    cond = not_in_lower(F.col(county_col), EXCLUDED_COUNTIES)
    if category_col is not None:
        cond = cond & not_in_lower(F.col(category_col), EXCLUDED_CATEGORIES)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def _as_list(v) -> list:
    if isinstance(v, (list, tuple, set, frozenset)):
        return list(v)
    return [v]


def apply_filters(df: DataFrame, county=None, year=None, month=None, category=None,
                  centre=None, **others) -> DataFrame:
    """Dashboard filters: each argument is a value or a list of values; None
    means no filter. ``month`` filters the month number, ``year`` the year
    text; extra keyword arguments filter columns of the same name."""
    spec = {"county": county, "year": year, "month": month, "test_category": category,
            "test_centre": centre, **others}
    conds = []
    for column, value in spec.items():
        if value is None:
            continue
        values = _as_list(value)
        if column == "year":
            values = [str(v) for v in values]
        conds.append(F.col(column).isin(values))
    if not conds:
        return df
    return df.filter(reduce(lambda a, b: a & b, conds))
