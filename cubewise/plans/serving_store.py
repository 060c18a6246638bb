"""A stored aggregate that answers the dashboard, refreshed month by month.

The dashboard groups a fact by any of a few dimensions under filters on them. The
store keeps, per month of the fact (``streaming.months``), one row per combination
of the dimensions with the sums and counts its questions are made of. Sums add up
along every dimension that a question leaves out, so each series, scorecard, rate and
top list is one small aggregate of the store; no fact is rebuilt or scanned.

Rows per month are bounded by the dimensions' labels, not by the fact. A hot
combination is summed map-side before it moves. A refresh reads the touched months of
the fact and swaps their snapshots in by one log entry; a question under a year or
month filter reads those months' folders only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubewise.operators.filters import apply_filters
from cubewise.streaming.months import PERIOD, MonthStore, in_months

# A fact's own month columns, and where present its centre.
DIMENSIONS = ["year", "month", "month_name", "date_month", "county", "test_centre", "test_category"]
RATE, WEIGHT = "pass_rate", "tests_delivered"


def _measures(fact: DataFrame) -> list[str]:
    return [f.name for f in fact.schema.fields if f.name not in DIMENSIONS and isinstance(f.dataType, T.NumericType)]


def _dimensions(fact: DataFrame) -> list[str]:
    return [c for c in DIMENSIONS if c in fact.columns]


def _sum_type(t: T.DataType) -> T.DataType:
    return T.DoubleType() if isinstance(t, (T.DoubleType, T.FloatType)) else T.LongType()


def store_schema(fact: DataFrame) -> T.StructType:
    """The stored columns: dimensions, a sum and a count a measure, the weighted rate's
    two sums, and the month of the snapshot."""
    types = {f.name: f.dataType for f in fact.schema.fields}
    fields = [T.StructField(c, types[c]) for c in _dimensions(fact)]
    for m in _measures(fact):
        fields += [T.StructField(m, _sum_type(types[m])), T.StructField(f"n_{m}", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ("rate_weighted", "rate_weight")]
    return T.StructType([*fields, T.StructField(PERIOD, T.DateType())])


def summed(fact: DataFrame) -> DataFrame:
    """A fact's rows -> the store's rows. Facts have one row a grain key, but months
    spelt differently meet here under their number."""
    both = F.col(RATE).isNotNull() & F.col(WEIGHT).isNotNull()
    rate, weight = F.col(RATE).cast("double"), F.col(WEIGHT).cast("double")
    sums = [c for m in _measures(fact) for c in (F.sum(m).alias(m), F.count(m).alias(f"n_{m}"))]
    sums += [F.sum(F.when(both, rate * weight)).alias("rate_weighted"), F.sum(F.when(both, weight)).alias("rate_weight")]
    return (fact.groupBy(*_dimensions(fact)).agg(*sums).withColumn(PERIOD, F.col("date_month").cast("date")))


def refresh_serving(fact: DataFrame, path: str, months: Iterable[str] | None = None) -> None:
    """Store the given months of a fact anew (all by default), in one step; a month
    the fact no longer has is gone. Months are named as in ``streaming.months.month_name``."""
    store = MonthStore(fact.sparkSession, path)
    wanted = None if months is None else sorted(set(months))
    rows = fact if wanted is None else (
        fact.withColumn(PERIOD, F.col("date_month").cast("date")).where(in_months(wanted)).drop(PERIOD))
    snapshots = store.write(summed(rows).select(*store_schema(fact).names))
    store.commit(store.months if wanted is None else wanted, snapshots)


class Serving:
    """The dashboard's questions, answered from a store."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.store = MonthStore(spark, path)
        self.schema = schema

    def rows(self, **filters) -> DataFrame:
        """The stored rows under the dashboard filters; a year or month filter leaves
        the other months' folders unread."""
        return apply_filters(self.store.read(self.schema, self._months(filters)), **filters).drop(PERIOD)

    def _months(self, filters: dict) -> list[str] | None:
        wanted = [{str(v) for v in ([f] if isinstance(f, (str, int)) else f)} if (f := filters.get(k)) is not None else None
                  for k in ("year", "month")]
        if wanted == [None, None]:
            return None
        years, numbers = wanted
        return [m for m in self.store.months if not m[:4].isdigit()
                or ((years is None or m[:4] in years) and (numbers is None or str(int(m[5:7])) in numbers))]

    def scorecards(self, **filters) -> DataFrame:
        return self.rows(**filters).agg(
            F.sum("tests_delivered").alias("tests_delivered"),
            F.sum("applications_received").alias("applications_received"),
            F.try_divide(F.sum(F.col(RATE).cast("double")), F.sum(f"n_{RATE}").cast("double")).alias("avg_pass_rate"),
            _weighted().alias("weighted_pass_rate"))

    def measure_by(self, dims: Sequence[str], measures: Sequence[str], **filters) -> DataFrame:
        return self.rows(**filters).groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures])

    def top_centres(self, measure: str = "applicants_waiting", n: int = 10, ascending: bool = True,
                    entity: str = "test_centre", **filters) -> DataFrame:
        order = F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)
        return self.measure_by([entity], [measure], **filters).orderBy(order, F.asc(entity)).limit(n)

    def yearly_rollup(self, entity: str, **filters) -> DataFrame:
        return self.rows(**filters).groupBy(entity, "year").agg(
            F.sum("tests_delivered").alias("tests_conducted"),
            F.sum("applications_received").alias("applications_received"),
            _weighted().alias("pass_rate"))


def _weighted() -> Column:
    return F.try_divide(F.sum("rate_weighted"), F.sum("rate_weight"))
