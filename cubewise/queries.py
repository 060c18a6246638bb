"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracles.

Every query reads the driver's tables (through the derived raw tables of
``cubewise.sources.derived``) in full; nothing is sampled or capped except
where a limit is the feature itself (top-k, preview).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubewise import oracle as O
from cubewise.functions import month_name, month_number, month_start, strip_county_prefix
from cubewise.operators.filters import apply_filters
from cubewise.operators.pivot import full_outer_on, pivot_measures
from cubewise.operators.project import to_snake_case
from cubewise.operators.quality import accepted_values, not_null, unique
from cubewise.operators.serving import measure_by, scorecards, top_centres, yearly_rollup
from cubewise.plans.cube_docs import cube_documents, cube_results
from cubewise.plans.facts import centre_fact, clean_centre_rows, county_fact
from cubewise.plans.landing import land_county_file, land_cube, load_county_checked, load_county_raw
from cubewise.plans.quality_suite import COUNTY_GRAIN, QUALITY_SUITE, STG_NOT_NULL, suite_report
from cubewise.plans.serving_store import Serving, refresh_serving, store_schema
from cubewise.plans.staging import stage_centre_stats, stage_county_stats
from cubewise.plans.warehouse import build_warehouse
from cubewise.schemas import (
    ACCEPTED_YEARS,
    APPLICATION_MEASURES,
    CENTRE_KEYS,
    CENTRE_TEST_MEASURES,
    COUNTY_KEYS,
    HEADER_LABEL,
    LANDING_CENTRE_NO_CATEGORY_SCHEMA,
    LANDING_CENTRE_SCHEMA,
    LANDING_COUNTY_SCHEMA,
    RAW_CENTRE_NO_CATEGORY_SCHEMA,
    RAW_CENTRE_SCHEMA,
)
from cubewise.session import scratch_path, table_path
from cubewise.sinks.files import COMPRESSED, as_view, land_csv, load_raw, materialize, preview
from cubewise.sinks.published import publish, read_published
from cubewise.sources.catalog import Catalog
from cubewise.sources.csv import clean_csv_rows
from cubewise.sources.derived import applications, lines, raw_api, raw_county, raw_ro30, raw_ro34, read_table
from cubewise.sources.jsonstat import (
    CENTRE_COLUMNS,
    parse_documents,
    read_documents,
    read_jsonstat,
    read_jsonstat_cells,
    validate_jsonstat,
)
from cubewise.sources.jsonstat_split import read_jsonstat_split
from cubewise.streaming.incremental import OtherSide, read_partitioned, start_incremental
from cubewise.streaming.months import MonthStore
from cubewise.streaming.quality_months import kept_report, refresh_checks

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# Shared inputs
# ---------------------------------------------------------------------------

def stg_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_centre_stats(raw_api(spark, sf_dir))


def stg_ro30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_centre_stats(raw_ro30(spark, sf_dir))


def landed_county(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """The county file after its landing clean-up (in-memory form of the
    land -> load path; the written form is ``csv_round_trip``)."""
    return clean_csv_rows(raw_county(spark, sf_dir, joined), "statistic_label", "value")


def stg_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_county_stats(landed_county(spark, sf_dir))


def county_fact_df(spark: SparkSession, sf_dir: str, agg: str = "max", **filters) -> DataFrame:
    return county_fact(stg_api(spark, sf_dir), stg_local(spark, sf_dir), agg, **filters)


def centre_fact_df(spark: SparkSession, sf_dir: str, agg: str = "max", **filters) -> DataFrame:
    return centre_fact(stg_api(spark, sf_dir), stg_ro30(spark, sf_dir), agg, **filters)


# ---------------------------------------------------------------------------
# Staging, cleaning, scalar functions
# ---------------------------------------------------------------------------

def q_stage_centre_stats(spark, sf_dir):
    return stg_api(spark, sf_dir)


def q_stage_centre_stats_no_category(spark, sf_dir):
    return stage_centre_stats(raw_ro34(spark, sf_dir), has_category=False)


def q_stage_county_stats(spark, sf_dir):
    return stg_local(spark, sf_dir)


def q_clean_county(spark, sf_dir):
    """Centre rows with totals removed and the county prefix stripped."""
    return clean_centre_rows(stg_api(spark, sf_dir), keep_centre=True)


def q_header_row_filter(spark, sf_dir):
    """County file as read headerless: its header line arrives as a row
    (value unparseable -> NULL) and must be dropped with the NULL labels."""
    raw = raw_county(spark, sf_dir)
    header = (spark.range(1).select(
        F.lit(HEADER_LABEL).alias("statistic_label"), F.lit("Month").alias("month"),
        F.lit("County").alias("county"), F.lit("Driving Test Categories").alias("driving_test_categories"),
        F.lit("UNIT").alias("unit"), F.lit(None).cast("double").alias("value")))
    return clean_csv_rows(header.unionByName(raw), "statistic_label", "value")


def _distinct_periods(spark, sf_dir) -> DataFrame:
    """Every distinct (year, month) spelling of the staged applications."""
    return stg_api(spark, sf_dir).select("year", "month").distinct()


def q_month_number(spark, sf_dir):
    return _distinct_periods(spark, sf_dir).select(
        "year", F.col("month").alias("month_text"), month_number("month").alias("month_no"))


def q_month_start(spark, sf_dir):
    return _distinct_periods(spark, sf_dir).select(
        "year", F.col("month").alias("month_text"),
        month_start("year", month_number("month")).alias("date_month"))


def q_month_name(spark, sf_dir):
    return _distinct_periods(spark, sf_dir).select(
        "year", F.col("month").alias("month_text"),
        month_name(month_start("year", month_number("month"))).alias("month_name"))


def q_strip_county_prefix(spark, sf_dir):
    s = stg_api(spark, sf_dir)
    return s.select(F.col("test_centre_raw"), F.col("county"),
                    strip_county_prefix("county").alias("county_clean")).distinct()


# ---------------------------------------------------------------------------
# Pivot, join, facts
# ---------------------------------------------------------------------------

def q_pivot_measures_max(spark, sf_dir):
    return pivot_measures(clean_centre_rows(stg_api(spark, sf_dir), keep_centre=True), CENTRE_KEYS,
                          "statistic", "stat_value", APPLICATION_MEASURES, "max")


def q_pivot_measures_sum(spark, sf_dir):
    return pivot_measures(clean_centre_rows(stg_api(spark, sf_dir)), COUNTY_KEYS,
                          "statistic", "stat_value", APPLICATION_MEASURES, "sum")


def q_full_outer_keys(spark, sf_dir):
    """Applications and tests pivots joined on the 4 county keys (no derived
    columns): one row per key present on either side; NULL keys never match."""
    a = pivot_measures(clean_centre_rows(stg_api(spark, sf_dir)), COUNTY_KEYS, "statistic",
                       "stat_value", APPLICATION_MEASURES)
    b = pivot_measures(clean_centre_rows(stg_ro30(spark, sf_dir)), COUNTY_KEYS, "statistic",
                       "stat_value", CENTRE_TEST_MEASURES)
    return full_outer_on(a, b, COUNTY_KEYS)


def q_county_fact(spark, sf_dir):
    return county_fact_df(spark, sf_dir)


def q_county_fact_sum(spark, sf_dir):
    return county_fact_df(spark, sf_dir, agg="sum")


def q_centre_fact(spark, sf_dir):
    return centre_fact_df(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "stage_centre_stats": q_stage_centre_stats,
    "stage_centre_stats_no_category": q_stage_centre_stats_no_category,
    "stage_county_stats": q_stage_county_stats,
    "clean_county": q_clean_county,
    "header_row_filter": q_header_row_filter,
    "month_number": q_month_number,
    "month_start": q_month_start,
    "month_name": q_month_name,
    "strip_county_prefix": q_strip_county_prefix,
    "pivot_measures_max": q_pivot_measures_max,
    "pivot_measures_sum": q_pivot_measures_sum,
    "full_outer_keys": q_full_outer_keys,
    "county_fact": q_county_fact,
    "county_fact_sum": q_county_fact_sum,
    "centre_fact": q_centre_fact,
}


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

_PERIODS = 'SELECT DISTINCT year, "month" FROM stg_api'

ORACLE: dict[str, str] = {
    "stage_centre_stats": O.with_base("SELECT * FROM stg_api"),
    "stage_centre_stats_no_category": O.with_base("SELECT * FROM stg_ro34"),
    "stage_county_stats": O.with_base("SELECT * FROM stg_local"),
    "clean_county": O.with_base("SELECT * FROM app_centre_stats"),
    "header_row_filter": O.with_base("""
      SELECT statistic_label, "month", county, driving_test_categories, unit,
             COALESCE(value, 0.0) AS value
      FROM (SELECT 'Statistic Label' AS statistic_label, 'Month' AS "month", 'County' AS county,
                   'Driving Test Categories' AS driving_test_categories, 'UNIT' AS unit,
                   CAST(NULL AS DOUBLE) AS value
            UNION ALL SELECT * FROM raw_county) t
      WHERE statistic_label <> 'Statistic Label'"""),
    "month_number": O.with_base(f"""
      SELECT year, "month" AS month_text, {O.month_number_sql('"month"')} AS month_no
      FROM ({_PERIODS}) p"""),
    "month_start": O.with_base(f"""
      SELECT year, "month" AS month_text,
             {O.month_start_sql('year', O.month_number_sql('"month"'))} AS date_month
      FROM ({_PERIODS}) p"""),
    "month_name": O.with_base(f"""
      SELECT year, "month" AS month_text,
             strftime({O.month_start_sql('year', O.month_number_sql('"month"'))}, '%B') AS month_name
      FROM ({_PERIODS}) p"""),
    "strip_county_prefix": O.with_base(f"""
      SELECT DISTINCT test_centre_raw, county, {O.strip_county_sql('county')} AS county_clean
      FROM stg_api"""),
    "pivot_measures_max": O.with_base("SELECT * FROM pivot_apps_centre"),
    "pivot_measures_sum": O.with_base("SELECT * FROM pivot_apps_county_sum"),
    "full_outer_keys": O.with_base(
        "SELECT * FROM (" + O._combine("pivot_apps_county", "pivot_ro30_county", O.COUNTY_KEYS,
                                       list(APPLICATION_MEASURES.values()),
                                       list(CENTRE_TEST_MEASURES.values())) + ") x"),
    "county_fact": O.with_base("SELECT * FROM county_fact"),
    "county_fact_sum": O.with_base("SELECT * FROM county_fact_sum"),
    "centre_fact": O.with_base("SELECT * FROM centre_fact"),
}


# ---------------------------------------------------------------------------
# Serving: filters, scorecards, chart series, top-k, yearly rollup
# ---------------------------------------------------------------------------


DASHBOARD_FILTER = {"year": ["2019", "2020"], "category": ["BUILDING", "MACHINERY"]}


def q_filtered_fact(spark, sf_dir):
    return county_fact_df(spark, sf_dir, county=["NATION_5", "NATION_9", "Co.NATION_2"],
                          year="2020", month=[1, 2, 3, 10], category="AUTOMOBILE")


def q_scorecards(spark, sf_dir):
    return scorecards(centre_fact_df(spark, sf_dir))


def q_scorecards_filtered(spark, sf_dir):
    return scorecards(centre_fact_df(spark, sf_dir, **DASHBOARD_FILTER))


def q_applications_by_category(spark, sf_dir):
    return measure_by(county_fact_df(spark, sf_dir), ["test_category"], ["applications_received"])


def q_applications_vs_delivered_by_month(spark, sf_dir):
    return measure_by(county_fact_df(spark, sf_dir), ["date_month"],
                      ["applications_received", "tests_delivered"])


def q_delivered_vs_no_shows(spark, sf_dir):
    return measure_by(county_fact_df(spark, sf_dir), ["county"], ["tests_delivered", "no_shows"])


def q_centre_applications_vs_delivered(spark, sf_dir):
    return measure_by(centre_fact_df(spark, sf_dir), ["test_centre"],
                      ["applications_received", "tests_delivered"])


def q_centre_delivered_over_time(spark, sf_dir):
    return measure_by(centre_fact_df(spark, sf_dir), ["date_month"], ["tests_delivered"])


def q_top10_least_waiting(spark, sf_dir):
    return top_centres(centre_fact_df(spark, sf_dir), "applicants_waiting", 10, ascending=True)


def county_population(spark, sf_dir) -> DataFrame:
    """Population per county, from the data: customers per nation."""
    c = read_table(spark, table_path(sf_dir, "customer")).select("c_nationkey")
    n = read_table(spark, table_path(sf_dir, "nation")).select("n_nationkey", "n_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("county")).agg(F.count(F.lit(1)).alias("population")))


def q_yearly_rollup_ratio(spark, sf_dir):
    return yearly_rollup(county_fact_df(spark, sf_dir), "county", county_population(spark, sf_dir))


QUERIES.update({
    "filtered_fact": q_filtered_fact,
    "scorecards": q_scorecards,
    "scorecards_filtered": q_scorecards_filtered,
    "applications_by_category": q_applications_by_category,
    "applications_vs_delivered_by_month": q_applications_vs_delivered_by_month,
    "delivered_vs_no_shows": q_delivered_vs_no_shows,
    "centre_applications_vs_delivered": q_centre_applications_vs_delivered,
    "centre_delivered_over_time": q_centre_delivered_over_time,
    "top10_least_waiting": q_top10_least_waiting,
    "yearly_rollup_ratio": q_yearly_rollup_ratio,
})


def _weighted_sql(rate: str, weight: str) -> str:
    both = f"{rate} IS NOT NULL AND {weight} IS NOT NULL"
    num = f"SUM(CASE WHEN {both} THEN CAST({rate} AS DOUBLE) * CAST({weight} AS DOUBLE) END)"
    den = f"SUM(CASE WHEN {both} THEN CAST({weight} AS DOUBLE) END)"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE {num} / {den} END"


def _scorecards_sql(where: str = "") -> str:
    return O.with_base(f"""
      SELECT CAST(SUM(tests_delivered) AS BIGINT) AS tests_delivered,
             CAST(SUM(applications_received) AS BIGINT) AS applications_received,
             CASE WHEN COUNT(pass_rate) = 0 THEN NULL
                  ELSE CAST(SUM(pass_rate) AS DOUBLE) / CAST(COUNT(pass_rate) AS DOUBLE) END AS avg_pass_rate,
             {_weighted_sql('pass_rate', 'tests_delivered')} AS weighted_pass_rate
      FROM centre_fact {where}""")


ORACLE.update({
    "filtered_fact": O.with_base("""
      SELECT * FROM county_fact
      WHERE county IN ('NATION_5', 'NATION_9', 'Co.NATION_2') AND year IN ('2020')
        AND "month" IN (1, 2, 3, 10) AND test_category IN ('AUTOMOBILE')"""),
    "scorecards": _scorecards_sql(),
    "scorecards_filtered": _scorecards_sql(
        "WHERE year IN ('2019', '2020') AND test_category IN ('BUILDING', 'MACHINERY')"),
    "applications_by_category": O.with_base("""
      SELECT test_category, CAST(SUM(applications_received) AS BIGINT) AS applications_received
      FROM county_fact GROUP BY test_category"""),
    "applications_vs_delivered_by_month": O.with_base("""
      SELECT date_month, CAST(SUM(applications_received) AS BIGINT) AS applications_received,
             SUM(tests_delivered) AS tests_delivered
      FROM county_fact GROUP BY date_month"""),
    "delivered_vs_no_shows": O.with_base("""
      SELECT county, SUM(tests_delivered) AS tests_delivered, SUM(no_shows) AS no_shows
      FROM county_fact GROUP BY county"""),
    "centre_applications_vs_delivered": O.with_base("""
      SELECT test_centre, CAST(SUM(applications_received) AS BIGINT) AS applications_received,
             CAST(SUM(tests_delivered) AS BIGINT) AS tests_delivered
      FROM centre_fact GROUP BY test_centre"""),
    "centre_delivered_over_time": O.with_base("""
      SELECT date_month, CAST(SUM(tests_delivered) AS BIGINT) AS tests_delivered
      FROM centre_fact GROUP BY date_month"""),
    "top10_least_waiting": O.with_base("""
      SELECT test_centre, CAST(SUM(applicants_waiting) AS BIGINT) AS applicants_waiting
      FROM centre_fact GROUP BY test_centre
      ORDER BY applicants_waiting ASC NULLS LAST, test_centre ASC LIMIT 10"""),
    "yearly_rollup_ratio": O.with_base(f"""
      SELECT r.*, p.population,
             CAST(r.tests_conducted AS DOUBLE) / CAST(p.population AS DOUBLE) AS tests_per_capita
      FROM (SELECT county, year, SUM(tests_delivered) AS tests_conducted,
                   CAST(SUM(applications_received) AS BIGINT) AS applications_received,
                   {_weighted_sql('pass_rate', 'tests_delivered')} AS pass_rate
            FROM county_fact GROUP BY county, year) r
      LEFT JOIN (SELECT n.n_name AS county, COUNT(*) AS population
                 FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                 GROUP BY n.n_name) p
        ON r.county = p.county"""),
})


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------


def q_dq_not_null(spark, sf_dir):
    return not_null(stg_api(spark, sf_dir), STG_NOT_NULL)


def q_dq_accepted_values(spark, sf_dir):
    return accepted_values(stg_api(spark, sf_dir), "year", ACCEPTED_YEARS)


def q_dq_unique(spark, sf_dir):
    return unique(county_fact_df(spark, sf_dir), COUNTY_GRAIN)


def q_dq_report(spark, sf_dir):
    """Checks run on the built models, as tests run after the models: each
    staging model and each fact is computed once and stored in the shared
    folder; each table's row-level checks (one pass) and unique check then
    read the columns they need."""
    def stored(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, scratch_path(spark, f"dq_{name}"), ())

    staged = {"stg_applications": stg_api(spark, sf_dir), "stg_county": stg_local(spark, sf_dir),
              "stg_tests": stg_ro30(spark, sf_dir),
              "stg_tests_no_category": stage_centre_stats(raw_ro34(spark, sf_dir), has_category=False)}
    tables = {name: stored(df, name) for name, df in staged.items()}
    tables["county_fact"] = stored(county_fact(tables["stg_applications"], tables["stg_county"]), "county_fact")
    tables["centre_fact"] = stored(centre_fact(tables["stg_applications"], tables["stg_tests"]), "centre_fact")
    return suite_report(tables)


QUERIES.update({
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_unique": q_dq_unique,
    "dq_report": q_dq_report,
})


def _key_sql(cols) -> str:
    return " || '-' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)


# The models' names in the SQL formulations.
_SQL_MODELS = {"stg_applications": "stg_api", "stg_county": "stg_local", "stg_tests": "stg_ro30",
               "stg_tests_no_category": "stg_ro34"}


def _report_sql(model: str, checks) -> list[str]:
    out, table = [], _SQL_MODELS.get(model, model)
    for c in checks:
        col = c.columns[0]
        if c.kind == "not_null":
            failing = f"(SELECT COUNT(*) FROM {table} WHERE {col} IS NULL)"
        elif c.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            failing = f"(SELECT COUNT(*) FROM {table} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
        else:
            k = _key_sql(c.columns)
            failing = (f"(SELECT COUNT(*) FROM (SELECT {k} AS k FROM {table} WHERE {k} IS NOT NULL "
                       f"GROUP BY k HAVING COUNT(*) > 1) d)")
        status = (f"CASE WHEN {failing} = 0 THEN 'pass' WHEN '{c.severity}' = 'warn' THEN 'warn' "
                  f"ELSE 'fail' END")
        out.append(f"SELECT '{model}' AS table_name, '{c.name}' AS check_name, "
                   f"'{c.column_label.replace(chr(39), chr(39) * 2)}' AS column_name, "
                   f"'{c.severity}' AS severity, "
                   f"CAST({failing} AS BIGINT) AS failing_rows, {status} AS status")
    return out


ORACLE.update({
    "dq_not_null": O.with_base(
        "SELECT *, concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in STG_NOT_NULL)
        + ") AS null_columns FROM stg_api WHERE " + " OR ".join(f"{c} IS NULL" for c in STG_NOT_NULL)),
    "dq_accepted_values": O.with_base(
        "SELECT * FROM stg_api WHERE year IS NOT NULL AND year NOT IN ("
        + ", ".join(f"'{y}'" for y in ACCEPTED_YEARS) + ")"),
    "dq_unique": O.with_base(
        f"SELECT {_key_sql(COUNTY_GRAIN)} AS unique_key, COUNT(*) AS n_records FROM county_fact "
        f"WHERE {_key_sql(COUNTY_GRAIN)} IS NOT NULL GROUP BY unique_key HAVING COUNT(*) > 1"),
    "dq_report": O.with_base("\nUNION ALL\n".join(
        line for t, checks in QUALITY_SUITE.items() for line in _report_sql(t, checks))),
})


# ---------------------------------------------------------------------------
# Sources and sinks: landing CSV, full-refresh loads, JSON-stat cubes
# ---------------------------------------------------------------------------


def q_csv_round_trip(spark, sf_dir):
    """County file written with a header line per part file -> landed
    (header rows and NULL labels dropped, NULL values -> 0.0) -> loaded."""
    source = scratch_path(spark, "county_source")
    published = raw_county(spark, sf_dir).toDF(*LANDING_COUNTY_SCHEMA.fieldNames())
    published.write.option("header", True).csv(source)
    landing = scratch_path(spark, "landing_county")
    land_county_file(spark, source, landing)
    return load_county_raw(spark, landing, scratch_path(spark, "raw_county"))


def _land_api_in_two_batches(spark, sf_dir) -> str:
    raw = raw_api(spark, sf_dir)
    landing = scratch_path(spark, "landing_api")
    first = F.coalesce(F.col("driving_test_categories").isin("AUTOMOBILE", "BUILDING"), F.lit(False))
    land_csv(raw.filter(first), landing)
    land_csv(raw.filter(~first), landing)
    return landing


def q_raw_load_overwrite(spark, sf_dir):
    """Two appended landing batches, loaded twice with full refresh: the
    second load replaces the first, so the table equals the source once."""
    landing = _land_api_in_two_batches(spark, sf_dir)
    target = scratch_path(spark, "raw_api")
    load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, target, RAW_CENTRE_SCHEMA)
    return load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, target, RAW_CENTRE_SCHEMA)


def q_reingest_max_idempotent(spark, sf_dir):
    """The same extract landed twice (append) duplicates every raw row; the
    MAX pivot at centre grain is unchanged by it."""
    raw = raw_api(spark, sf_dir)
    landing = scratch_path(spark, "landing_api")
    land_csv(raw, landing)
    land_csv(raw, landing)
    loaded = load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, scratch_path(spark, "raw_api"),
                      RAW_CENTRE_SCHEMA)
    return pivot_measures(clean_centre_rows(stage_centre_stats(loaded), keep_centre=True), CENTRE_KEYS,
                          "statistic", "stat_value", APPLICATION_MEASURES, "max")


# Mostly empty cells, so the text shrinks; a compressed file is read by one task.
CUBE_FILES = COMPRESSED | {"maxRecordsPerFile": 2000}


def _write_cubes(spark, sf_dir) -> str:
    path = scratch_path(spark, "cubes")
    cube_documents(applications(spark, sf_dir)).select("json").write.options(**CUBE_FILES).text(path)
    return path


def q_jsonstat_flatten(spark, sf_dir):
    """Cubes (one per nation and year) written as JSON-stat documents, read
    back and flattened to long rows (empty cells -> 0)."""
    rows, _rejected = read_jsonstat(spark, _write_cubes(spark, sf_dir), CENTRE_COLUMNS, layout="lines")
    return to_snake_case(rows.drop("doc"))


def q_cube_land_load(spark, sf_dir):
    """Cubes -> landing CSV (by position) -> full-refresh raw table."""
    landing = scratch_path(spark, "landing_cube")
    land_cube(spark, _write_cubes(spark, sf_dir), landing, CENTRE_COLUMNS, layout="lines")
    return load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, scratch_path(spark, "raw_cube"),
                    RAW_CENTRE_SCHEMA)


def q_preview(spark, sf_dir):
    return preview(raw_api(spark, sf_dir), 10)


QUERIES.update({
    "csv_round_trip": q_csv_round_trip,
    "raw_load_overwrite": q_raw_load_overwrite,
    "reingest_max_idempotent": q_reingest_max_idempotent,
    "jsonstat_flatten": q_jsonstat_flatten,
    "cube_land_load": q_cube_land_load,
    "preview": q_preview,
})

_CUBE_SQL = """
  WITH d AS (SELECT n_nationkey AS dn, substr("month", 1, 4) AS dy, doc_block AS db, statistic, "month",
                    driving_test_categories AS cat, driving_test_centre AS centre FROM apps_long),
  k AS (SELECT dn, dy, db, statistic, "month", cat, centre, COUNT(*) AS n FROM d
        GROUP BY dn, dy, db, statistic, "month", cat, centre),
  s AS (SELECT DISTINCT dn, dy, db, statistic FROM d),
  m AS (SELECT DISTINCT dn, dy, db, "month" FROM d),
  c AS (SELECT DISTINCT dn, dy, db, cat FROM d),
  z AS (SELECT DISTINCT dn, dy, db, centre FROM d)
  SELECT s.statistic, m."month", c.cat AS driving_test_categories, z.centre AS driving_test_centre,
         'Number' AS unit, CAST(COALESCE(k.n, 0) AS BIGINT) AS value
  FROM s JOIN m USING (dn, dy, db) JOIN c USING (dn, dy, db) JOIN z USING (dn, dy, db)
         LEFT JOIN k ON k.dn = s.dn AND k.dy = s.dy AND k.db = s.db AND k.statistic = s.statistic
                    AND k."month" = m."month" AND k.cat = c.cat AND k.centre = z.centre"""

ORACLE.update({
    "csv_round_trip": O.with_base("SELECT * FROM landed_county"),
    "raw_load_overwrite": O.with_base("SELECT * FROM raw_api"),
    "reingest_max_idempotent": O.with_base("SELECT * FROM pivot_apps_centre"),
    "jsonstat_flatten": O.with_base("SELECT * FROM (" + _CUBE_SQL + ") x"),
    "cube_land_load": O.with_base("SELECT * FROM (" + _CUBE_SQL + ") x"),
})


# ---------------------------------------------------------------------------
# Streaming: incremental landing
# ---------------------------------------------------------------------------


def centre_applications_pivot(staged: DataFrame) -> DataFrame:
    return pivot_measures(clean_centre_rows(staged, keep_centre=True), CENTRE_KEYS, "statistic",
                          "stat_value", APPLICATION_MEASURES, "max")


def q_incremental_landing(spark, sf_dir):
    """Applications landed in two batches; each run of the stream refreshes
    only the months its files touch. The result equals the batch pivot."""
    raw = raw_api(spark, sf_dir)
    landing, state, fact, ckpt = (scratch_path(spark, p) for p in
                                  ("stream_landing", "stream_state", "stream_fact", "stream_ckpt"))
    first = F.coalesce(F.col("month") < F.lit("2021"), F.lit(False))
    for part in (raw.filter(first), raw.filter(~first)):
        land_csv(part, landing)
        q = start_incremental(spark, landing, LANDING_CENTRE_SCHEMA, state, fact, ckpt,
                              centre_applications_pivot)
        q.awaitTermination()
    schema = T.StructType(
        [T.StructField(k, T.StringType(), True) for k in CENTRE_KEYS]
        + [T.StructField(m, T.LongType(), True) for m in APPLICATION_MEASURES.values()]
        + [T.StructField("period", T.DateType(), True)])
    return read_partitioned(spark, fact, schema).drop("period")


def q_incremental_county_fact(spark, sf_dir):
    """Both sides of the county fact landed in parts, one stream a side; each
    run refreshes the months its files touch from both sides' staged history.
    The last landing repeats the first (a replayed extract), which the MAX
    absorbs. The result equals the batch county fact."""
    names = ("landing", "state", "checkpoint")
    apps = {n: scratch_path(spark, f"stream_apps_{n}") for n in names}
    tests = {n: scratch_path(spark, f"stream_county_{n}") for n in names}
    fact_dir = scratch_path(spark, "stream_county_fact")

    def refresh(side, rows, schema, stage, other, build):
        land_csv(rows, side["landing"])
        start_incremental(spark, side["landing"], schema, side["state"], fact_dir, side["checkpoint"], build,
                          stage, other=other).awaitTermination()

    def refresh_apps(rows):
        other = OtherSide(tests["state"], LANDING_COUNTY_SCHEMA, stage_county_stats)
        refresh(apps, rows, LANDING_CENTRE_SCHEMA, stage_centre_stats, other, county_fact)

    def refresh_tests(rows):
        other = OtherSide(apps["state"], LANDING_CENTRE_SCHEMA, stage_centre_stats)
        refresh(tests, rows, LANDING_COUNTY_SCHEMA, stage_county_stats, other,
                lambda own, applied: county_fact(applied, own))

    raw, county = raw_api(spark, sf_dir), landed_county(spark, sf_dir)
    early = F.coalesce(F.col("month") < F.lit("2021"), F.lit(False))
    refresh_apps(raw.filter(early))
    refresh_tests(county)
    refresh_apps(raw.filter(~early))
    refresh_apps(raw.filter(early))
    schema = county_fact_df(spark, sf_dir).schema.add("period", T.DateType())
    return read_partitioned(spark, fact_dir, schema).drop("period")


def q_incremental_revision(spark, sf_dir):
    """The county fact by SUM over a stream of extracts: all applications five times
    too high, then as they are, then one statistic lowered; the first extract's files
    come again at the end, late, in an epoch of their own for the months before 2021,
    followed by the right values. Per series and month the last extract counts."""
    landing, state, fact_dir, checkpoint = (scratch_path(spark, f"revision_{n}") for n in ("landing", "state", "fact", "checkpoint"))
    tests = {n: scratch_path(spark, f"revision_county_{n}") for n in ("landing", "state", "checkpoint")}
    raw, county = raw_api(spark, sf_dir), landed_county(spark, sf_dir)
    early = F.coalesce(F.col("month") < F.lit("2021"), F.lit(False))
    value = F.when(F.col("statistic") == REVISED, -F.col("value")).otherwise(F.col("value"))

    def apps(rows):
        land_csv(rows, landing)
        start_incremental(spark, landing, LANDING_CENTRE_SCHEMA, state, fact_dir, checkpoint,
                          lambda own, other: county_fact(own, other, "sum"), keys=SERIES, fact_snapshots=True,
                          other=OtherSide(tests["state"], LANDING_COUNTY_SCHEMA, stage_county_stats)).awaitTermination()

    apps(raw.withColumn("value", F.col("value") * 5))
    land_csv(county, tests["landing"])
    start_incremental(spark, tests["landing"], LANDING_COUNTY_SCHEMA, tests["state"], fact_dir, tests["checkpoint"],
                      lambda own, other: county_fact(other, own, "sum"), stage_county_stats, fact_snapshots=True,
                      other=OtherSide(state, LANDING_CENTRE_SCHEMA, stage_centre_stats)).awaitTermination()
    apps(raw)
    apps(raw.filter(early).withColumn("value", F.col("value") * 7))
    apps(raw.withColumn("value", value))
    MonthStore(spark, fact_dir).compact()
    return MonthStore(spark, fact_dir).read(county_fact_df(spark, sf_dir).schema).drop("period")


REVISED = "Driving Test Applications Received"
SERIES = ["statistic", "year", "month", "test_category", "test_centre_raw"]

QUERIES["incremental_landing"] = q_incremental_landing
QUERIES["incremental_revision"] = q_incremental_revision
QUERIES["incremental_county_fact"] = q_incremental_county_fact
LOWERED_SQL = O.with_base("SELECT * FROM county_fact_sum").replace(
    "o.o_orderkey AS value", "CASE WHEN o.o_orderpriority = '1-URGENT' THEN -o.o_orderkey ELSE o.o_orderkey END AS value")
ORACLE["incremental_revision"] = LOWERED_SQL
ORACLE["incremental_landing"] = O.with_base("SELECT * FROM pivot_apps_centre")
ORACLE["incremental_county_fact"] = O.with_base("SELECT * FROM county_fact")


# ---------------------------------------------------------------------------
# Named sources, views and stored facts
# ---------------------------------------------------------------------------


def q_county_fact_from_sources(spark, sf_dir):
    """The county fact with its inputs resolved by name: raw tables are
    registered as named sources, staging models exposed as views."""
    cat = Catalog(spark)
    cat.register_view("staging", "applications", raw_api(spark, sf_dir))
    cat.register_view("staging", "county_file", landed_county(spark, sf_dir))
    stg_a = as_view(stage_centre_stats(cat.source("staging", "applications")),
                    "staged_applications")
    stg_l = as_view(stage_county_stats(cat.source("staging", "county_file")),
                    "staged_county_file")
    return county_fact(stg_a, stg_l)


def q_fact_year_partition_filter(spark, sf_dir):
    """County fact stored partitioned by year; a dashboard year filter then
    reads only that year's directory (partition pruning)."""
    stored = materialize(county_fact_df(spark, sf_dir), scratch_path(spark, "county_fact"), ("year",))
    return apply_filters(stored, year="2020", category=["BUILDING", "AUTOMOBILE"])


QUERIES.update({
    "county_fact_from_sources": q_county_fact_from_sources,
    "fact_year_partition_filter": q_fact_year_partition_filter,
})
ORACLE.update({
    "county_fact_from_sources": O.with_base("SELECT * FROM county_fact"),
    "fact_year_partition_filter": O.with_base(
        "SELECT * FROM county_fact WHERE year IN ('2020') AND test_category IN ('BUILDING', 'AUTOMOBILE')"),
})


# ---------------------------------------------------------------------------
# Document validation on landed cubes
# ---------------------------------------------------------------------------


def q_jsonstat_rejected(spark, sf_dir):
    """Cubes landed with defects, as an API may return them: nation 0's
    documents lack the dimension order, nation 1's carry a text cell. Each
    document is counted as valid or under its reject reason."""
    docs = cube_documents(applications(spark, sf_dir))
    text = F.col("json")
    defective = (F.when(F.col("doc_nation") == 0, F.regexp_replace(text, r'"id":\[[^\]]*\]', '"id":[]'))
                 .when(F.col("doc_nation") == 1, F.regexp_replace(text, r'"value":\[', '"value":["..",'))
                 .otherwise(text))
    path = scratch_path(spark, "cubes_defective")
    docs.select(defective.alias("json")).write.text(path)
    valid, rejected = validate_jsonstat(parse_documents(read_documents(spark, path, layout="lines")))
    return (valid.agg(F.count(F.lit(1)).alias("documents")).select(F.lit("valid").alias("status"), "documents")
            .unionByName(rejected.groupBy(F.col("reject_reason").alias("status"))
                         .agg(F.count(F.lit(1)).alias("documents"))))


QUERIES["jsonstat_rejected"] = q_jsonstat_rejected
ORACLE["jsonstat_rejected"] = O.with_base("""
  SELECT CASE WHEN dn = 0 THEN 'no-dimension-order'
              WHEN dn = 1 THEN 'malformed-document' ELSE 'valid' END AS status,
         COUNT(*) AS documents
  FROM (SELECT DISTINCT n_nationkey AS dn, substr("month", 1, 4) AS dy, doc_block FROM apps_long) d
  GROUP BY 1""")


def _write_awkward_cubes(spark, sf_dir) -> str:
    """Cubes whose ``value`` is an object by position in even years; in odd years it is
    an array in which every figure 2 is suppressed (a text cell)."""
    docs = cube_results(applications(spark, sf_dir)).withColumnRenamed("doc_year", "year")
    keyed = F.col("result").withField("value", F.map_from_arrays(
        F.transform(F.sequence(F.lit(0), F.size("result.value") - 1), lambda i: i.cast("string")), F.col("result.value")))
    form = {"ignoreNullFields": "false"}
    as_object = F.to_json(F.struct(keyed.alias("result")), form)
    as_array = F.regexp_replace(F.to_json(F.struct("result"), form), r"2\.0(?=[,\]])(?<=[\[,]2\.0)", '".."')
    path = scratch_path(spark, "cubes_awkward")
    docs.select(F.when(F.col("year").cast("int") % 2 == 0, as_object).otherwise(as_array).alias("json")).write.options(**CUBE_FILES).text(path)
    return path


def q_jsonstat_cells(spark, sf_dir):
    """Cubes of both forms of ``value``, some cells text: the rows of all figures."""
    rows, _faults, _rejected = read_jsonstat_cells(spark, _write_awkward_cubes(spark, sf_dir), layout="lines")
    return to_snake_case(rows.drop("doc"))


def q_jsonstat_cell_faults(spark, sf_dir):
    """The same cubes' cells that are no figures, each with its labels."""
    _rows, faults, _rejected = read_jsonstat_cells(spark, _write_awkward_cubes(spark, sf_dir), layout="lines")
    return to_snake_case(faults.drop("doc", "UNIT"))


QUERIES |= {"jsonstat_cells": q_jsonstat_cells, "jsonstat_cell_faults": q_jsonstat_cell_faults}
_SUPPRESSED = 'CAST(substr("month", 1, 4) AS INTEGER) % 2 = 1 AND "value" = 2'
ORACLE["jsonstat_cells"] = O.with_base(f"SELECT * FROM ({_CUBE_SQL}) x WHERE NOT ({_SUPPRESSED})")
ORACLE["jsonstat_cell_faults"] = O.with_base(f"""
  SELECT * EXCLUDE ("value", unit), '".."' AS cell FROM ({_CUBE_SQL}) x WHERE {_SUPPRESSED}""")


def q_jsonstat_split(spark, sf_dir):
    """One national cube a year, one document a file, its cells parsed by byte ranges."""
    national = applications(spark, sf_dir).withColumn("n_nationkey", F.lit(0)).withColumn("doc_block", F.lit(0))
    path = scratch_path(spark, "cubes_national")
    cube_documents(national).select("json", "doc_year").write.partitionBy("doc_year").text(path)
    rows, _rejected = read_jsonstat_split(spark, path)
    return to_snake_case(rows.drop("doc"))


QUERIES["jsonstat_split"] = q_jsonstat_split
ORACLE["jsonstat_split"] = O.with_base("SELECT * FROM (" + _CUBE_SQL.replace(
    "SELECT n_nationkey AS dn,", "SELECT 0 AS dn,").replace("doc_block AS db", "0 AS db") + ") x")


def q_reingest_latest_wins(spark, sf_dir):
    """Full extract landed as batch 0001, then a revised re-extract of one
    statistic (values + 1) as batch 0002; the load keeps, per key, the rows
    of the latest batch, so revised keys take the new values and every other
    key keeps the first extract."""
    raw = raw_api(spark, sf_dir)
    landing = scratch_path(spark, "landing_batches")
    land_csv(raw, landing, batch="0001")
    revised_stat = "Driving Test Applications Received"
    revision = raw.filter(F.col("statistic") == revised_stat).withColumn("value", F.col("value") + 1)
    land_csv(revision, landing, batch="0002")
    keys = ["statistic", "month", "driving_test_categories", "driving_test_centre"]
    return load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, scratch_path(spark, "raw_latest"),
                    RAW_CENTRE_SCHEMA, latest_wins=keys)


QUERIES["reingest_latest_wins"] = q_reingest_latest_wins
ORACLE["reingest_latest_wins"] = O.with_base("""
  SELECT statistic, "month", driving_test_categories, driving_test_centre, unit,
         CASE WHEN statistic = 'Driving Test Applications Received' THEN value + 1 ELSE value END AS value
  FROM raw_api""")


def _warehouse(spark, sf_dir, agg="max", revised=False):
    """Landing folders -> full warehouse build (raw loads, staging views,
    stored facts, quality report). ``revised``: the applications come unbatched,
    and again in two batches, the last of which lowers one statistic."""
    landing = {name: scratch_path(spark, f"wh landing 100%_é_{name}") for name in ("apps", "tests", "county", "ro34")}
    raw = raw_api(spark, sf_dir)
    land_csv(raw, landing["apps"])
    if revised:
        land_csv(raw.withColumn("value", F.col("value") * 5), landing["apps"], batch="0001")
        land_csv(raw, landing["apps"], batch="0002")
        lowered = raw.filter(F.col("statistic") == REVISED).withColumn("value", -F.col("value"))
        land_csv(lowered, landing["apps"], batch="0010")
    # Three landings are made of the joined line items: joined once.
    joined = materialize(lines(spark, sf_dir), scratch_path(spark, "lines"), ())
    land_csv(raw_ro30(spark, sf_dir, joined), landing["tests"])
    land_csv(landed_county(spark, sf_dir, joined), landing["county"])
    land_csv(raw_ro34(spark, sf_dir, joined), landing["ro34"])
    return build_warehouse(spark, landing["apps"], landing["tests"], landing["county"],
                           scratch_path(spark, "warehouse"), agg, revised, landing["ro34"])


def q_warehouse_county_fact(spark, sf_dir):
    return _warehouse(spark, sf_dir).county_fact


def q_warehouse_centre_fact(spark, sf_dir):
    return _warehouse(spark, sf_dir).centre_fact


def q_warehouse_ro34(spark, sf_dir):
    return _warehouse(spark, sf_dir).stg_tests_no_category


def q_warehouse_report(spark, sf_dir):
    return _warehouse(spark, sf_dir).report


def q_warehouse_latest_wins(spark, sf_dir):
    """Revised extracts through the whole load: the latest batch counts, once."""
    return _warehouse(spark, sf_dir, "sum", revised=True).county_fact


def q_single_file_landing(spark, sf_dir):
    """The tests table without category, landed as a single file and loaded."""
    landing = scratch_path(spark, "landing_single")
    land_csv(raw_ro34(spark, sf_dir), landing, single_file=True)
    return load_raw(spark, landing + "/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, scratch_path(spark, "raw_single"),
                    RAW_CENTRE_NO_CATEGORY_SCHEMA)


def q_preview_rows(spark, sf_dir):
    """How many rows the preview shows, and how many of them are in the table."""
    raw = raw_api(spark, sf_dir)
    shown = preview(raw, 10)
    found = shown.join(raw.distinct(), raw.columns, "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("shown")).join(found.agg(F.count(F.lit(1)).alias("found")))


def q_text_round_trip(spark, sf_dir):
    """Labels with quotes, separators, blanks, line breaks and empty texts,
    landed and loaded again."""
    landing = scratch_path(spark, "landing_text")
    land_csv(_awkward(raw_ro34(spark, sf_dir)), landing)
    return load_raw(spark, landing + "/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, scratch_path(spark, "raw_text"),
                    RAW_CENTRE_NO_CATEGORY_SCHEMA)


def _awkward(raw: DataFrame) -> DataFrame:
    kind, centre = F.col("value") % 6, F.col("driving_test_centre")
    return raw.withColumn("driving_test_centre", (
        F.when(kind == 0, F.concat(F.lit('say "'), centre, F.lit('", ok')))
        .when(kind == 1, F.concat(F.lit("  "), centre, F.lit(" \t")))
        .when(kind == 2, F.concat(centre, F.lit("\nline\r\nend")))
        .when(kind == 3, F.lit("")).when(kind == 4, F.lit(None).cast("string")).otherwise(centre)))


def q_load_quarantine(spark, sf_dir):
    """The county file as another writer left it: every seventh label holds a quoted
    line break, every eleventh value is text, every thirteenth line has a field too
    many. Good rows are loaded; what each label lost is counted from the quarantine."""
    raw = landed_county(spark, sf_dir).withColumn("key", F.col("value").cast("long"))
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("\\N")), F.lit('"'), F.lit('""')), F.lit('"'))
              for c in raw.columns[:-2]]
    kind = F.when(F.col("key") % 7 == 0, "broken").when(F.col("key") % 11 == 0, "text").when(F.col("key") % 13 == 0, "extra")
    label = F.when(kind == "broken", F.concat(F.lit('"line'), F.lit("\n"), F.substring(quoted[0], 2, 1 << 20))).otherwise(quoted[0])
    value = (F.when(kind == "text", F.lit("n/a")).when(kind == "extra", F.concat(F.col("value").cast("string"), F.lit(",x")))
             .otherwise(F.col("value").cast("string")))
    landing = scratch_path(spark, "landing_foreign")
    raw.select(F.concat_ws(",", label, *quoted[1:], value).alias("value")).write.text(landing)
    done = load_county_checked(spark, landing, scratch_path(spark, "raw_checked"))
    lines = done.quarantine.select(
        F.when(F.col("line").startswith('"line'), "broken, first line").when(F.col("line").endswith(",n/a"), "text")
        .when(F.col("line").endswith(",x"), "extra").otherwise("broken, second line").alias("status"))
    loaded = done.table.agg(F.count("*").alias("lines"), F.sum("value").alias("total")).select(F.lit("loaded").alias("status"), "lines", "total")
    counts = lines.groupBy("status").agg(F.count("*").alias("lines")).withColumn("total", F.lit(None).cast("double"))
    return loaded.unionByName(counts).unionByName(spark.range(1).select(
        F.lit("counted bad").alias("status"), F.lit(done.bad).cast("long").alias("lines"), F.lit(None).cast("double").alias("total")))


def q_landing_retried(spark, sf_dir):
    """The county fact by SUM where every batch was landed twice under its id and one
    attempt never came to its commit: each batch counts once."""
    raw = raw_api(spark, sf_dir)
    early = F.coalesce(F.col("month") < F.lit("2021"), F.lit(False))
    landing = scratch_path(spark, "landing retried")
    for _ in range(2):
        land_csv(raw.filter(early), landing, batch="0001")
        land_csv(raw.filter(~early), landing, batch="0002")
    raw.write.csv(f"{landing}/0003/attempt")
    apps = load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, scratch_path(spark, "raw_retried"), RAW_CENTRE_SCHEMA)
    return county_fact(stage_centre_stats(apps), stg_local(spark, sf_dir), "sum")


def q_failed_refresh(spark, sf_dir):
    """The county fact published, then refreshed by a job that fails on its last row:
    readers still get the fact of before."""
    target = scratch_path(spark, "published fact")
    fact = publish(county_fact_df(spark, sf_dir), target, ("year",))
    lost = F.when(F.xxhash64("county", "month") % 5 == 0, F.raise_error("lost")).otherwise(F.col("county")).cast("string")
    try:
        publish(fact.withColumn("county", lost), target, ("year",))
    except Exception as e:  # the failure is the point; any other is not
        if "lost" not in str(e):
            raise
    return read_published(spark, target)


def q_dq_refreshed(spark, sf_dir):
    """The county fact's checks kept by month: counted on a fact that lost its counties
    before 2021, then only those months counted again on the right one."""
    checks, kept = QUALITY_SUITE["county_fact"], scratch_path(spark, "kept checks")
    fact = publish(county_fact_df(spark, sf_dir), scratch_path(spark, "checked fact"), ("year",))
    county = F.when(F.year("date_month") < 2021, None).otherwise(F.col("county"))
    refresh_checks(spark, kept, fact.withColumn("county", county), checks, "date_month")
    spoilt = [m for m in MonthStore(spark, kept).months if m < "2021"]
    refresh_checks(spark, kept, fact, checks, "date_month", spoilt)
    return kept_report(spark, kept, "county_fact", checks)


def _serving(spark, fact) -> Serving:
    """A store of a fact's sums: filled from a fact whose figures before 2021 were
    one too high and whose later months were missing, then refreshed for those months."""
    path = scratch_path(spark, "serving store")
    fact = publish(fact, scratch_path(spark, "served fact"), ("year",))
    spoilt = fact.where("date_month is null or date_month < '2022-01-01'").withColumn(
        "applications_received", F.when(F.col("date_month") < "2021-01-01", F.col("applications_received") + 1)
        .otherwise(F.col("applications_received")))
    refresh_serving(spoilt, path)
    months = [str(r[0]) for r in fact.select("date_month").where("date_month < '2021-01-01' or date_month >= '2022-01-01'")
              .distinct().collect()]  # bounded by the calendar
    refresh_serving(fact, path, months)
    return Serving(spark, path, store_schema(fact))


def q_serving_scorecards(spark, sf_dir):
    return _serving(spark, centre_fact_df(spark, sf_dir)).scorecards(**DASHBOARD_FILTER)


def q_serving_top10(spark, sf_dir):
    return _serving(spark, centre_fact_df(spark, sf_dir)).top_centres("applicants_waiting", 10)


def q_serving_series(spark, sf_dir):
    """Three chart series of the county fact, from one store."""
    store, measures = _serving(spark, county_fact_df(spark, sf_dir)), ["applications_received", "tests_delivered", "no_shows"]
    series = [store.measure_by([d], measures).select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("label"), *measures)
              for d in ("test_category", "date_month", "county")]
    return series[0].unionByName(series[1]).unionByName(series[2])


def q_serving_rollup(spark, sf_dir):
    return _serving(spark, county_fact_df(spark, sf_dir)).yearly_rollup("county")


QUERIES.update({
    "serving_scorecards": q_serving_scorecards,
    "serving_top10": q_serving_top10,
    "serving_series": q_serving_series,
    "serving_rollup": q_serving_rollup,
    "dq_refreshed": q_dq_refreshed,
    "load_quarantine": q_load_quarantine,
    "landing_retried": q_landing_retried,
    "failed_refresh": q_failed_refresh,
    "warehouse_county_fact": q_warehouse_county_fact,
    "warehouse_centre_fact": q_warehouse_centre_fact,
    "warehouse_ro34": q_warehouse_ro34,
    "warehouse_report": q_warehouse_report,
    "warehouse_latest_wins": q_warehouse_latest_wins,
    "single_file_landing": q_single_file_landing,
    "preview_rows": q_preview_rows,
    "text_round_trip": q_text_round_trip,
})
ORACLE.update({
    "serving_scorecards": ORACLE["scorecards_filtered"],
    "serving_top10": ORACLE["top10_least_waiting"],
    "serving_series": O.with_base("\nUNION ALL\n".join(f"""
      SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS label, CAST(SUM(applications_received) AS BIGINT) AS applications_received,
             SUM(tests_delivered) AS tests_delivered, SUM(no_shows) AS no_shows
      FROM county_fact GROUP BY {d}""" for d in ("test_category", "date_month", "county"))),
    "serving_rollup": O.with_base(f"""
      SELECT county, year, SUM(tests_delivered) AS tests_conducted,
             CAST(SUM(applications_received) AS BIGINT) AS applications_received,
             {_weighted_sql('pass_rate', 'tests_delivered')} AS pass_rate
      FROM county_fact GROUP BY county, year"""),
    "dq_refreshed": f"SELECT * FROM ({ORACLE['dq_report']}) r WHERE table_name = 'county_fact'",
    "load_quarantine": O.with_base("""
      SELECT status, COUNT(*) AS lines, CASE WHEN status = 'loaded' THEN SUM(value) END AS total FROM (
        SELECT value, unnest(CASE WHEN CAST(value AS BIGINT) % 7 = 0 THEN ['broken, first line', 'broken, second line', 'counted bad', 'counted bad']
                                  WHEN CAST(value AS BIGINT) % 11 = 0 THEN ['text', 'counted bad']
                                  WHEN CAST(value AS BIGINT) % 13 = 0 THEN ['extra', 'counted bad'] ELSE ['loaded'] END) AS status
        FROM landed_county) x GROUP BY status"""),
    "landing_retried": O.with_base("SELECT * FROM county_fact_sum"),
    "failed_refresh": O.with_base("SELECT * FROM county_fact"),
    "warehouse_county_fact": O.with_base("SELECT * FROM county_fact"),
    "warehouse_centre_fact": O.with_base("SELECT * FROM centre_fact"),
    "warehouse_ro34": O.with_base("SELECT * FROM stg_ro34"),
    "warehouse_report": ORACLE["dq_report"],
    "warehouse_latest_wins": LOWERED_SQL,
    "single_file_landing": O.with_base("SELECT * FROM raw_ro34"),
    "preview_rows": O.with_base("SELECT least(count(*), 10) AS shown, least(count(*), 10) AS found FROM raw_api"),
    "text_round_trip": O.with_base("""
      SELECT statistic, "month", unit, value,
             CASE value % 6 WHEN 0 THEN 'say "' || driving_test_centre || '", ok'
                            WHEN 1 THEN '  ' || driving_test_centre || ' ' || chr(9)
                            WHEN 2 THEN driving_test_centre || chr(10) || 'line' || chr(13) || chr(10) || 'end'
                            WHEN 3 THEN '' WHEN 4 THEN NULL ELSE driving_test_centre END AS driving_test_centre
      FROM raw_ro34"""),
})
