"""Data-quality results kept month by month.

Of a table with a month column the failing rows of each check are counted per
month and stored as month snapshots (``streaming.months``). After a refresh only
the refreshed months are counted again; the report adds up the months. A unique
check can be kept so only if its key holds the month column: then no key spans two
months, and the counts of duplicated keys add up too.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubewise.operators.quality import Check, _failing_condition, _report_row, unique_key
from cubewise.streaming.months import PERIOD, MonthStore, in_months

COUNTS = T.StructType([T.StructField("check_name", T.StringType()), T.StructField("failing", T.LongType())])


def month_counts(df: DataFrame, checks: Sequence[Check], month_col: str) -> DataFrame:
    """(check_name, failing, period): failing rows, or duplicated keys, per check and month."""
    loose = [c.name for c in checks if c.kind == "unique" and month_col not in c.columns]
    if loose:
        raise ValueError(f"keys without {month_col} may span months: {', '.join(loose)}")
    dated = df.withColumn(PERIOD, F.col(month_col).cast("date"))
    parts = []
    if row_checks := [c for c in checks if c.kind != "unique"]:
        counted = dated.groupBy(PERIOD).agg(*[F.count_if(_failing_condition(c)).alias(f"c{n}") for n, c in enumerate(row_checks)])
        named = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{n}").alias("failing")) for n, c in enumerate(row_checks)])
        parts.append(counted.select(F.inline(named), PERIOD))
    for c in checks:
        if c.kind == "unique":
            keys = (dated.select(PERIOD, unique_key(c.columns).alias("key")).where("key is not null")
                    .groupBy(PERIOD, "key").agg(F.count("*").alias("n")).where("n > 1"))
            parts.append(keys.groupBy(PERIOD).agg(F.count("*").alias("failing")).select(
                F.lit(c.name).alias("check_name"), "failing", PERIOD))
    return reduce(lambda a, b: a.unionByName(b), parts)


def refresh_checks(spark: SparkSession, path: str, df: DataFrame, checks: Sequence[Check], month_col: str,
                   months: Iterable[str] | None = None) -> None:
    """Count the given months of a table again (all by default) and swap them in; a
    month the table no longer has is gone."""
    store = MonthStore(spark, path)
    wanted = None if months is None else sorted(set(months))
    rows = df if wanted is None else (
        df.withColumn(PERIOD, F.col(month_col).cast("date")).where(in_months(wanted)).drop(PERIOD))
    store.commit(store.months if wanted is None else wanted, store.write(month_counts(rows, checks, month_col)))


def kept_report(spark: SparkSession, path: str, table: str, checks: Sequence[Check]) -> DataFrame:
    """The report of ``operators.quality.quality_report``, from the months' counts."""
    totals = MonthStore(spark, path).read(COUNTS).agg(*[
        F.coalesce(F.sum(F.when(F.col("check_name") == c.name, F.col("failing"))), F.lit(0)).alias(f"c{n}")
        for n, c in enumerate(checks)])
    return totals.select(F.inline(F.array(*[_report_row(table, c, F.col(f"c{n}")) for n, c in enumerate(checks)])))
