"""Extract/load pipelines: source files and cubes -> landing CSV -> raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cubewise.schemas import LANDING_COUNTY_SCHEMA, RAW_COUNTY_SCHEMA
from cubewise.sinks.files import CheckedLoad, land_csv, load_checked, load_raw
from cubewise.sources.csv import clean_csv_rows, read_landing_csv
from cubewise.sources.jsonstat import CENTRE_COLUMNS, read_jsonstat


def land_county_file(spark: SparkSession, source: str | list[str], landing_dir: str,
                     single_file: bool = False) -> None:
    """County CSV (with a header line) -> landing CSV (headerless, append).

    The source is read by position without header handling, so its header
    line arrives as a row and is removed by the label filter; NULL values
    become 0.0.
    """
    raw = read_landing_csv(spark, source, LANDING_COUNTY_SCHEMA, header=False)
    land_csv(clean_csv_rows(raw, "Statistic Label", "VALUE"), landing_dir, header=False,
             single_file=single_file)


class RejectedDocuments(ValueError):
    pass


def land_cube(spark: SparkSession, docs_path: str | list[str], landing_dir: str,
              columns: Sequence[str] = tuple(CENTRE_COLUMNS), layout: str = "file",
              fail_on_reject: bool = True, rebalance: bool = False) -> DataFrame:
    """Landed JSON-stat documents -> landing CSV (headerless, append), in
    the declared column order. Any rejected document raises before anything is
    landed, with the counts by reason; all of them are written beside the
    landing folder, under ``<landing_dir>_rejected``. With
    ``fail_on_reject=False`` the good documents are landed and the rejected ones
    returned."""
    rows, rejected = read_jsonstat(spark, docs_path, columns, layout, rebalance)
    if fail_on_reject:
        reasons = rejected.groupBy("reject_reason").count().orderBy("reject_reason").collect()
        if reasons:
            beside = landing_dir.rstrip("/") + "_rejected"
            rejected.select("doc", "reject_reason").write.mode("overwrite").json(beside)
            raise RejectedDocuments("; ".join(f"{r['reject_reason']}: {r['count']} documents" for r in reasons)
                                    + f"; listed in {beside}")
    land_csv(rows.select(*columns, "UNIT", "VALUE"), landing_dir, header=False)
    return rejected


def load_county_checked(spark: SparkSession, landing_dir: str, target: str) -> CheckedLoad:
    """Landing CSV of the county file -> raw county table, with the lines that
    cannot be read set aside and counted."""
    return load_checked(spark, landing_dir.rstrip("/") + "/*", LANDING_COUNTY_SCHEMA, target, RAW_COUNTY_SCHEMA)


def load_county_raw(spark: SparkSession, landing_dir: str, target: str) -> DataFrame:
    """Landing CSV of the county file -> raw county table (full refresh)."""
    return load_raw(spark, landing_dir.rstrip("/") + "/*", LANDING_COUNTY_SCHEMA, target, RAW_COUNTY_SCHEMA)
