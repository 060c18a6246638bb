"""Build the warehouse from landing folders: raw loads -> staging views ->
stored facts -> quality report (the load, build and test steps in order)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cubewise.plans.facts import centre_fact, county_fact
from cubewise.plans.quality_suite import suite_report
from cubewise.plans.staging import ROWS, condensed, stage_centre_stats, stage_county_stats
from cubewise.schemas import (
    LANDING_CENTRE_NO_CATEGORY_SCHEMA,
    LANDING_CENTRE_SCHEMA,
    LANDING_COUNTY_SCHEMA,
    RAW_CENTRE_NO_CATEGORY_SCHEMA,
    RAW_CENTRE_SCHEMA,
    RAW_COUNTY_SCHEMA,
)
from cubewise.session import scratch_path
from cubewise.sinks.files import as_view, load_raw, materialize
from cubewise.sinks.published import publish


@dataclass
class Warehouse:
    raw_applications: DataFrame
    raw_tests: DataFrame
    raw_county: DataFrame
    stg_applications: DataFrame
    stg_tests: DataFrame
    stg_county: DataFrame
    county_fact: DataFrame
    centre_fact: DataFrame
    report: DataFrame
    raw_tests_no_category: DataFrame | None = None
    stg_tests_no_category: DataFrame | None = None


def _glob(path: str) -> str:
    return path.rstrip("/") + "/*"


def build_warehouse(spark: SparkSession, applications_landing: str, tests_landing: str,
                    county_landing: str, target: str, agg: str = "max", latest_wins: bool = False,
                    tests_no_category_landing: str | None = None) -> Warehouse:
    """Full refresh of every table under ``target`` (a shared location).

    Raw tables are written once and read back, so both facts and the checks
    scan stored Parquet rather than re-parsing landing CSV; the facts are
    published partitioned by year (``sinks.published``: a failed refresh leaves
    the tables of before). Staging stays a view. Facts and checks read the staged form
    of the condensed raw tables (equal rows once, with their number), stored in the
    scratch folder, so that each raw table is scanned once. ``latest_wins``: of the
    rows of one series and month only those of the latest landing batch count.
    The tests without category are loaded, staged and checked where their
    landing folder is given; no fact reads them.
    """
    root = target.rstrip("/")

    def load(landing, landing_schema, schema, name):
        keys = [f.name for f in schema.fields if f.name not in ("unit", "value")] if latest_wins else None
        return load_raw(spark, _glob(landing), landing_schema, f"{root}/{name}", schema, keys)

    def condense(raw: DataFrame, agg: str) -> DataFrame:
        return materialize(condensed(raw, agg), scratch_path(spark, "condensed"), ())

    raw_a = load(applications_landing, LANDING_CENTRE_SCHEMA, RAW_CENTRE_SCHEMA, "raw_applications")
    raw_t = load(tests_landing, LANDING_CENTRE_SCHEMA, RAW_CENTRE_SCHEMA, "raw_tests")
    raw_c = load(county_landing, LANDING_COUNTY_SCHEMA, RAW_COUNTY_SCHEMA, "raw_county")
    models = {
        "stg_applications": as_view(stage_centre_stats(raw_a), "stg_applications"),
        "stg_county": as_view(stage_county_stats(raw_c), "stg_county"),
        "stg_tests": as_view(stage_centre_stats(raw_t), "stg_tests"),
    }
    raw_n = None
    kept = {
        "stg_applications": stage_centre_stats(condense(raw_a, agg), keep=[ROWS]),
        "stg_county": stage_county_stats(condense(raw_c, agg), keep=[ROWS]),
        "stg_tests": stage_centre_stats(condense(raw_t, agg), keep=[ROWS]),
    }
    if tests_no_category_landing:
        raw_n = load(tests_no_category_landing, LANDING_CENTRE_NO_CATEGORY_SCHEMA, RAW_CENTRE_NO_CATEGORY_SCHEMA,
                     "raw_tests_no_category")
        models["stg_tests_no_category"] = as_view(stage_centre_stats(raw_n, has_category=False),
                                                  "stg_tests_no_category")
        kept["stg_tests_no_category"] = stage_centre_stats(condense(raw_n, agg), has_category=False, keep=[ROWS])

    cf = publish(county_fact(kept["stg_applications"], kept["stg_county"], agg), f"{root}/county_fact", ("year",))
    tf = publish(centre_fact(kept["stg_applications"], kept["stg_tests"], agg), f"{root}/centre_fact", ("year",))
    report = suite_report(kept | {"county_fact": cf, "centre_fact": tf}, ROWS)
    return Warehouse(raw_a, raw_t, raw_c, models["stg_applications"], models["stg_tests"], models["stg_county"], cf, tf, report,
                     raw_n, models.get("stg_tests_no_category"))
