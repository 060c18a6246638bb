"""Declarative data-quality checks. Each check returns its failing rows; the
report computes every row-level check of a table in one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str                     # 'not_null' | 'accepted_values' | 'unique'
    columns: tuple[str, ...]      # one column, or the parts of a unique key
    values: tuple = field(default=())
    severity: str = "error"       # 'error' | 'warn'

    @property
    def name(self) -> str:
        return f"{self.kind}_{'_'.join(self.columns)}"

    @property
    def column_label(self) -> str:
        return " || '-' || ".join(self.columns)


def not_null_check(*cols: str, severity: str = "error") -> list[Check]:
    return [Check("not_null", (c,), severity=severity) for c in cols]


def accepted_values_check(col: str, values: Sequence, severity: str = "error") -> Check:
    return Check("accepted_values", (col,), tuple(str(v) for v in values), severity)


def unique_check(*cols: str, severity: str = "error") -> Check:
    return Check("unique", tuple(cols), severity=severity)


# ---------------------------------------------------------------------------
# Failing rows
# ---------------------------------------------------------------------------

def _failing_condition(check: Check) -> Column:
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.cast("string").isin(list(check.values))
    raise ValueError(f"{check.kind} is not a row-level check")


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols``, with the list of NULL columns."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.filter(cond).withColumn("null_columns", names)


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose (non-NULL) ``col`` is outside ``values``."""
    return df.filter(_failing_condition(accepted_values_check(col, values)))


def unique_key(cols: Sequence[str]) -> Column:
    """``a || '-' || b ...``: NULL when any part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.col(c).cast("string"))
    return F.concat(*parts)


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (NULL keys skipped), with counts.

    A grouped count with map-side partial aggregation: a key holding a large
    share of rows is reduced to one partial count per task before the shuffle.
    """
    k = unique_key(cols)
    return (df.select(k.alias("unique_key")).filter(F.col("unique_key").isNotNull())
            .groupBy("unique_key").agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


# ---------------------------------------------------------------------------
# Report
# ---------------------------------------------------------------------------

def _report_row(table: str, check: Check, failing: Column) -> Column:
    status = (F.when(failing == 0, F.lit("pass"))
              .when(F.lit(check.severity) == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return F.struct(F.lit(table).alias("table_name"), F.lit(check.name).alias("check_name"),
                    F.lit(check.column_label).alias("column_name"),
                    F.lit(check.severity).alias("severity"),
                    failing.cast("bigint").alias("failing_rows"), status.alias("status"))


def quality_report(table: str, df: DataFrame, checks: Sequence[Check], weight: str | None = None) -> DataFrame:
    """One row per check: table_name, check_name, column_name, severity,
    failing_rows, status ('pass' | 'warn' | 'fail').

    Row-level checks share a single scan (one ``count_if`` per check); each
    unique check is one grouped count, failing once per duplicated key. ``weight``: a
    column with the number of rows that a row stands for (no unique checks then).
    """
    if weight and any(c.kind == "unique" for c in checks):
        raise ValueError("unique checks need the rows themselves")
    row_checks = [c for c in checks if c.kind != "unique"]
    parts: list[DataFrame] = []
    if row_checks:
        def failing(c: Check) -> Column:
            cond = _failing_condition(c)
            return F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)) if weight else F.count_if(cond)

        counts = df.agg(*[failing(c).alias(f"c{i}") for i, c in enumerate(row_checks)])
        rows = F.array(*[_report_row(table, c, F.col(f"c{i}")) for i, c in enumerate(row_checks)])
        parts.append(counts.select(F.inline(rows)))
    for c in checks:
        if c.kind == "unique":
            dup = unique(df, c.columns).agg(F.count(F.lit(1)).alias("n"))
            parts.append(dup.select(F.inline(F.array(_report_row(table, c, F.col("n"))))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def combine_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)
