"""Staging models: raw warehouse tables -> typed, split, county-tagged rows.

Each is one ``select`` over its input, so it stays a lazy view (the staging
layer is never materialised) and Catalyst prunes and pushes through it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.functions import county_from_centre, period_month, period_year, safe_cast
from cubewise.operators.pivot import AGGREGATES


ROWS = "n_rows"


def condensed(raw: DataFrame, agg: str = "max") -> DataFrame:
    """Raw rows that are equal in all but their value as one row: its value their
    largest or their sum (NULLs apart from figures), ``n_rows`` their number. Facts with
    the same aggregate and weighted checks come out the same, and the text functions of
    staging run once for each kind of row."""
    labels = [c for c in raw.columns if c != "value"]
    return (raw.groupBy(*labels, F.col("value").isNull().alias("_empty"))
            .agg(AGGREGATES[agg]("value").alias("value"), F.count(F.lit(1)).alias(ROWS)).drop("_empty"))


def stage_centre_stats(raw: DataFrame, has_category: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Raw centre-level table -> statistic, year, month, [test_category],
    test_centre_raw, county, unit (the value as bigint).

    ``year`` and ``month`` both come from the source ``month`` column in one
    projection, so neither sees the other's alias. ``keep``: columns that stay as they are.
    """
    cols = [
        F.col("statistic"),
        period_year("month").alias("year"),
        period_month("month").alias("month"),
    ]
    if has_category:
        cols.append(F.col("driving_test_categories").alias("test_category"))
    cols += [
        F.col("driving_test_centre").alias("test_centre_raw"),
        county_from_centre("driving_test_centre").alias("county"),
        safe_cast("value", "bigint").alias("unit"),
        *[F.col(c) for c in keep],
    ]
    return raw.select(*cols)


def stage_county_stats(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw county table -> statistic_label, year, month, county,
    driving_test_categories, unit, value."""
    return raw.select(
        F.col("statistic_label"),
        period_year("month").alias("year"),
        period_month("month").alias("month"),
        F.col("county"),
        F.col("driving_test_categories"),
        F.col("unit"),
        F.col("value"),
        *[F.col(c) for c in keep],
    )
