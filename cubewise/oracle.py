"""Independent SQL formulations (DuckDB dialect) of the registered queries.

Each query here is written directly from the semantics, not generated from
the Spark code, and runs on the driver's tables registered as views. The
Spark and SQL results are compared row-set by row-set.
"""

from __future__ import annotations

from cubewise.schemas import (
    APPLICATION_MEASURES,
    CENTRE_TEST_MEASURES,
    COUNTY_TEST_MEASURES,
)

# ---------------------------------------------------------------------------
# Expression fragments
# ---------------------------------------------------------------------------


def month_number_sql(m: str) -> str:
    names = "coalesce(try_strptime({0}, '%B'), try_strptime({0}, '%b'))".format(m)
    return (f"CAST(CASE WHEN regexp_full_match({m}, '[A-Za-z]+') THEN month({names}) "
            f"ELSE TRY_CAST({m} AS BIGINT) END AS BIGINT)")


def month_start_sql(y: str, mn: str) -> str:
    year = f"TRY_CAST({y} AS INTEGER)"
    return f"CASE WHEN {mn} BETWEEN 1 AND 12 AND {year} BETWEEN 1 AND 9999 THEN make_date({year}, {mn}, 1) END"


def strip_county_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^Co\\.?\\s+', ''), '^\\s+|\\s+$', '', 'g')"


def county_from_centre_sql(c: str) -> str:
    return (f"CASE WHEN {c} = 'All driving test centres' THEN 'Ireland' "
            f"ELSE nullif(regexp_extract({c}, ',\\s*(Co\\.\\s*\\w+)', 1), '') END")


def _year(d: str) -> str:
    return f"CAST(year({d}) + 23 AS VARCHAR)"


def _period_full(d: str) -> str:
    return f"{_year(d)} || ' ' || strftime({d}, '%B')"


def pivot_sql(src: str, keys: list[str], label: str, value: str, measures: dict[str, str],
              agg: str = "max", cast: str | None = None) -> str:
    def one(lab: str) -> str:
        e = f"{agg.upper()}(CASE WHEN {label} = '{lab}' THEN {value} END)"
        return f"CAST({e} AS {cast})" if cast else e

    cols = ",\n    ".join(f"{one(lab)} AS {name}" for lab, name in measures.items())
    k = ", ".join(f'"{x}"' for x in keys)
    return f"SELECT {k},\n    {cols}\n  FROM {src} GROUP BY {k}"


# ---------------------------------------------------------------------------
# Base relations (CTE bodies)
# ---------------------------------------------------------------------------

_SLOT = "CAST(c.c_custkey % 7 AS VARCHAR)"

BASE: dict[str, str] = {}

BASE["cust"] = f"""
  SELECT c.c_custkey, c.c_mktsegment, n.n_nationkey, n.n_name,
    CASE WHEN n.n_nationkey = 0 THEN 'All driving test centres'
         WHEN n.n_nationkey = 1 THEN 'Centre ' || {_SLOT}
         WHEN n.n_nationkey = 2 THEN 'Centre ' || {_SLOT} || ', Co.' || n.n_name
         ELSE 'Centre ' || {_SLOT} || ', Co. ' || n.n_name END AS centre,
    CASE WHEN n.n_nationkey = 0 THEN 'Ireland' ELSE 'Co. ' || n.n_name END AS county_label
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

_OD = "o.o_orderdate"
BASE["apps_long"] = f"""
  SELECT
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Driving Test Applications Received'
         WHEN o.o_orderpriority = '2-HIGH' THEN 'Driving Test Applicants Waiting at Month End'
         WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Driving Test Applicants Scheduled at Month End'
         WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'Driving Test Applicants Paused at Month End'
         WHEN o.o_orderstatus = 'F' THEN 'Driving Test Applicants Deferred'
         ELSE 'Driving Test Applicants Not Eligible at Month End' END AS statistic,
    CASE WHEN o.o_orderstatus <> 'P' THEN {_period_full(_OD)}
         WHEN o.o_orderpriority = '1-URGENT' THEN {_year(_OD)} || ' ' || strftime({_OD}, '%b')
         WHEN o.o_orderpriority = '2-HIGH' THEN {_year(_OD)} || ' ' || upper(strftime({_OD}, '%b'))
         WHEN o.o_orderpriority = '3-MEDIUM' THEN {_year(_OD)} || ' ' || CASE o.o_orderkey % 10 WHEN 0 THEN '123' WHEN 1 THEN '13' WHEN 2 THEN '0'
              ELSE CAST(month({_OD}) AS VARCHAR) END
         WHEN o.o_orderpriority = '4-NOT SPECIFIED'
              THEN {_year(_OD)} || 'M' || lpad(CAST(month({_OD}) AS VARCHAR), 2, '0')
         ELSE {_period_full(_OD)} END AS "month",
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' AND o.o_orderstatus = 'O' THEN 'All Test Categories'
         ELSE c.c_mktsegment END AS driving_test_categories,
    c.centre AS driving_test_centre,
    'Number' AS unit,
    o.o_orderkey AS value,
    c.n_nationkey,
    o.o_custkey // 500 AS doc_block
  FROM orders o JOIN cust c ON o.o_custkey = c.c_custkey"""

BASE["raw_api"] = """
  SELECT statistic, "month", driving_test_categories, driving_test_centre, unit, value
  FROM apps_long"""

BASE["lines"] = """
  SELECT l.l_orderkey, l.l_quantity, l.l_returnflag, l.l_linestatus, l.l_shipdate, c.*
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN cust c ON o.o_custkey = c.c_custkey"""

BASE["raw_ro30"] = f"""
  SELECT
    CASE WHEN l_linestatus = 'O' THEN 'Driving Tests Booked'
         WHEN l_quantity > 45 THEN 'Driving Tests Not Conducted / Abandoned'
         WHEN l_returnflag = 'R' THEN 'Driving Tests Delivered'
         WHEN l_returnflag = 'A' THEN 'Driving Test Pass Rate'
         ELSE 'Driving Test No-Shows' END AS statistic,
    {_period_full('l_shipdate')} AS "month",
    c_mktsegment AS driving_test_categories,
    centre AS driving_test_centre,
    'Number' AS unit,
    l_orderkey AS value
  FROM lines"""

BASE["raw_ro34"] = """
  SELECT statistic, "month", driving_test_centre, unit, value FROM raw_ro30"""

BASE["raw_county"] = f"""
  SELECT
    CASE WHEN l_quantity = 1 THEN NULL
         WHEN l_linestatus = 'O' THEN 'Driving Tests Booked'
         WHEN l_returnflag = 'R' THEN 'Driving Tests Delivered'
         WHEN l_returnflag = 'A' THEN 'Driving Test Pass Rate'
         ELSE 'Driving Test No-Shows' END AS statistic_label,
    {_period_full('l_shipdate')} AS "month",
    county_label AS county,
    c_mktsegment AS driving_test_categories,
    'Number' AS unit,
    CASE WHEN l_quantity > 48 THEN NULL ELSE l_quantity END AS value
  FROM lines"""

BASE["landed_county"] = """
  SELECT statistic_label, "month", county, driving_test_categories, unit,
         COALESCE(CAST(value AS DOUBLE), 0.0) AS value
  FROM raw_county WHERE statistic_label <> 'Statistic Label'"""


def _stage_centre(src: str, has_category: bool) -> str:
    cat = "r.driving_test_categories AS test_category," if has_category else ""
    return f"""
  SELECT r.statistic,
    string_split(r."month", ' ')[1] AS year,
    string_split(r."month", ' ')[2] AS "month",
    {cat}
    r.driving_test_centre AS test_centre_raw,
    {county_from_centre_sql('r.driving_test_centre')} AS county,
    TRY_CAST(r.value AS BIGINT) AS unit
  FROM {src} r"""


BASE["stg_api"] = _stage_centre("raw_api", True)
BASE["stg_ro30"] = _stage_centre("raw_ro30", True)
BASE["stg_ro34"] = _stage_centre("raw_ro34", False)
BASE["stg_local"] = """
  SELECT r.statistic_label,
    string_split(r."month", ' ')[1] AS year,
    string_split(r."month", ' ')[2] AS "month",
    r.county, r.driving_test_categories, r.unit, r.value
  FROM landed_county r"""


def _clean_centre(src: str, keep_centre: bool) -> str:
    centre = "test_centre_raw AS test_centre," if keep_centre else ""
    extra = "AND test_centre_raw IS NOT NULL" if keep_centre else ""
    return f"""
  SELECT year, "month", {strip_county_sql('county')} AS county, {centre}
    test_category, statistic, unit AS stat_value
  FROM {src}
  WHERE lower(county) NOT IN ('ireland') AND county IS NOT NULL
    AND lower(test_category) NOT IN ('all test categories') AND test_category IS NOT NULL {extra}"""


BASE["app_stats"] = _clean_centre("stg_api", False)
BASE["app_centre_stats"] = _clean_centre("stg_api", True)
BASE["ro30_stats"] = _clean_centre("stg_ro30", True)
BASE["local_stats"] = f"""
  SELECT year, "month", {strip_county_sql('county')} AS county,
    driving_test_categories AS test_category, statistic_label,
    TRY_CAST(value AS DOUBLE) AS stat_value
  FROM stg_local
  WHERE lower(county) NOT IN ('ireland') AND county IS NOT NULL
    AND lower(driving_test_categories) NOT IN ('all test categories')
    AND driving_test_categories IS NOT NULL"""

COUNTY_KEYS = ["year", "month", "county", "test_category"]
CENTRE_KEYS = ["year", "month", "county", "test_centre", "test_category"]


def _combine(a: str, b: str, keys: list[str], a_cols: list[str], b_cols: list[str]) -> str:
    on = " AND ".join(f'a."{k}" = b."{k}"' for k in keys)
    coalesced = ", ".join(f'COALESCE(a."{k}", b."{k}") AS "{k}"' for k in keys)
    measures = ", ".join([f"a.{c}" for c in a_cols] + [f"b.{c}" for c in b_cols])
    return f"SELECT {coalesced}, {measures} FROM {a} a FULL OUTER JOIN {b} b ON {on}"


def _calendar(src: str, other_cols: list[str]) -> str:
    mn = month_number_sql('j."month"')
    rest = ", ".join(f'j."{c}"' for c in other_cols)
    return f"""
  SELECT j.year, {mn} AS "month",
    strftime({month_start_sql('j.year', mn)}, '%B') AS month_name,
    {month_start_sql('j.year', mn)} AS date_month,
    {rest}
  FROM {src} j"""


BASE["pivot_apps_county"] = pivot_sql("app_stats", COUNTY_KEYS, "statistic", "stat_value",
                                      APPLICATION_MEASURES)
BASE["pivot_local"] = pivot_sql("local_stats", COUNTY_KEYS, "statistic_label", "stat_value",
                                COUNTY_TEST_MEASURES)
BASE["pivot_apps_centre"] = pivot_sql("app_centre_stats", CENTRE_KEYS, "statistic", "stat_value",
                                      APPLICATION_MEASURES)
BASE["pivot_ro30"] = pivot_sql("ro30_stats", CENTRE_KEYS, "statistic", "stat_value",
                               CENTRE_TEST_MEASURES)
BASE["ro30_county_stats"] = _clean_centre("stg_ro30", False)
BASE["pivot_ro30_county"] = pivot_sql("ro30_county_stats", COUNTY_KEYS, "statistic", "stat_value",
                                      CENTRE_TEST_MEASURES)
BASE["pivot_apps_county_sum"] = pivot_sql("app_stats", COUNTY_KEYS, "statistic", "stat_value",
                                          APPLICATION_MEASURES, "sum", "BIGINT")
BASE["pivot_local_sum"] = pivot_sql("local_stats", COUNTY_KEYS, "statistic_label", "stat_value",
                                    COUNTY_TEST_MEASURES, "sum", "DOUBLE")
BASE["county_joined"] = _combine("pivot_apps_county", "pivot_local", COUNTY_KEYS,
                                 list(APPLICATION_MEASURES.values()), list(COUNTY_TEST_MEASURES.values()))
BASE["centre_joined"] = _combine("pivot_apps_centre", "pivot_ro30", CENTRE_KEYS,
                                 list(APPLICATION_MEASURES.values()), list(CENTRE_TEST_MEASURES.values()))
BASE["county_joined_sum"] = _combine("pivot_apps_county_sum", "pivot_local_sum", COUNTY_KEYS,
                                     list(APPLICATION_MEASURES.values()),
                                     list(COUNTY_TEST_MEASURES.values()))
BASE["county_fact_sum"] = _calendar("county_joined_sum", ["county", "test_category",
                                                          *APPLICATION_MEASURES.values(),
                                                          *COUNTY_TEST_MEASURES.values()])
BASE["county_fact"] = _calendar("county_joined", ["county", "test_category",
                                                  *APPLICATION_MEASURES.values(),
                                                  *COUNTY_TEST_MEASURES.values()])
BASE["centre_fact"] = _calendar("centre_joined", ["county", "test_centre", "test_category",
                                                  *APPLICATION_MEASURES.values(),
                                                  *CENTRE_TEST_MEASURES.values()])

_BASE_ORDER = list(BASE)


def with_base(body: str) -> str:
    """Prefix ``body`` with the base CTEs it (transitively) needs."""
    import re

    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _BASE_ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.append(name)
                visit(BASE[name])

    visit(body)
    ordered = [n for n in _BASE_ORDER if n in needed]
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({BASE[n]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"
