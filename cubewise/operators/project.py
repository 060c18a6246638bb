"""Projection and renaming helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from cubewise.schemas import snake_case


def project(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def to_snake_case(df: DataFrame) -> DataFrame:
    """'Driving Test Centre' -> 'driving_test_centre' for every column."""
    return rename(df, {c: snake_case(c) for c in df.columns if snake_case(c) != c})
