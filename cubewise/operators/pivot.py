"""Long -> wide pivot by conditional aggregate, and the keyed full outer join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGGREGATES = {"max": F.max, "sum": F.sum, "min": F.min}


def pivot_measures(df: DataFrame, keys: Sequence[str], label_col: str, value_col: str,
                   measures: Mapping[str, str], agg: str = "max") -> DataFrame:
    """One output column per measure label: ``agg(CASE WHEN label = L THEN v END)``.

    A single hash aggregate with a map-side partial step, so a key holding a
    large share of the rows is pre-reduced in every task before the shuffle.
    Groups whose labels match no measure still produce a row (all NULL).
    ``max`` keeps the largest of duplicate or revised rows; ``sum`` adds them.
    """
    fn = AGGREGATES[agg]
    label, value = F.col(label_col), F.col(value_col)
    cols = [fn(F.when(label == F.lit(lab), value)).alias(name) for lab, name in measures.items()]
    return df.groupBy(*keys).agg(*cols)


def full_outer_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer equi-join on a list of key names; keys come out coalesced.

    Keys compare with ``=``: a NULL key never matches, and both sides are
    kept. When both inputs were aggregated on exactly these keys, the join
    reuses their hash partitioning (no extra exchange).
    """
    return left.join(right, list(keys), "full_outer")
