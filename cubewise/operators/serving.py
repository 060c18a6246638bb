"""Dashboard questions over the facts: scorecards, chart series, top-k.

Each is a filter followed by one grouped aggregate with a
map-side partial step; results are small by construction (one row per
dimension value). Over a stored fact the filter reaches the scan, and prunes
years where the fact is partitioned by year. Over a fact that the query itself
builds, pass the filters to ``county_fact`` or ``centre_fact`` instead: Spark does
not push a filter on coalesced keys below a full outer join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubewise.operators.filters import apply_filters


def weighted_rate(rate: str, weight: str) -> Column:
    """sum(rate * weight) / sum(weight) over rows where both are present."""
    both = F.col(rate).isNotNull() & F.col(weight).isNotNull()
    num = F.sum(F.when(both, F.col(rate).cast("double") * F.col(weight).cast("double")))
    den = F.sum(F.when(both, F.col(weight).cast("double")))
    return F.try_divide(num, den)


def mean(c: str) -> Column:
    """Average of the non-NULL values as one double division."""
    return F.try_divide(F.sum(F.col(c).cast("double")), F.count(c).cast("double"))


def scorecards(fact: DataFrame, **filters) -> DataFrame:
    """One row: total tests delivered, total applications received, average
    and delivery-weighted pass rate, under the dashboard filters."""
    f = apply_filters(fact, **filters)
    return f.agg(
        F.sum("tests_delivered").alias("tests_delivered"),
        F.sum("applications_received").alias("applications_received"),
        mean("pass_rate").alias("avg_pass_rate"),
        weighted_rate("pass_rate", "tests_delivered").alias("weighted_pass_rate"),
    )


def measure_by(fact: DataFrame, dims: Sequence[str], measures: Sequence[str], **filters) -> DataFrame:
    """Chart series: ``sum(measure)`` per value of ``dims`` (same names out)."""
    f = apply_filters(fact, **filters)
    return f.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures])


def top_centres(fact: DataFrame, measure: str = "applicants_waiting", n: int = 10,
                ascending: bool = True, entity: str = "test_centre", **filters) -> DataFrame:
    """The ``n`` centres with the smallest (or largest) total ``measure``.

    Aggregate, then order by (measure, centre) and take ``n``: Spark plans
    this as TakeOrderedAndProject, a per-partition top-n merged on one task,
    so nothing but n rows per partition moves. NULL totals sort last.
    """
    f = apply_filters(fact, **filters)
    agg = f.groupBy(entity).agg(F.sum(measure).alias(measure))
    order = F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)
    return agg.orderBy(order, F.asc(entity)).limit(n)


def yearly_rollup(fact: DataFrame, entity_col: str, population: DataFrame | None = None,
                  population_col: str = "population", **filters) -> DataFrame:
    """Yearly totals per entity with ratios: tests conducted, applications,
    weighted pass rate and, given a population table keyed by the entity
    (and optionally year), tests per capita."""
    f = apply_filters(fact, **filters)
    out = f.groupBy(entity_col, "year").agg(
        F.sum("tests_delivered").alias("tests_conducted"),
        F.sum("applications_received").alias("applications_received"),
        weighted_rate("pass_rate", "tests_delivered").alias("pass_rate"),
    )
    if population is not None:
        keys = [entity_col] + (["year"] if "year" in population.columns else [])
        out = (out.join(population.select(*keys, population_col), keys, "left")
               .withColumn("tests_per_capita",
                           F.try_divide(F.col("tests_conducted").cast("double"),
                                        F.col(population_col).cast("double"))))
    return out
