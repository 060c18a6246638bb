"""Declared schemas and fixed label values.

Every table in the pipeline has a fixed, declared schema; nothing is inferred.
Landing files are headerless CSV matched by position, so the landing schemas
below also fix the column order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source statistics exactly (case-sensitive)
# for the facts to pick the right rows.
# ---------------------------------------------------------------------------

# Statistic labels of the applications cube (centre x category), fact column names.
APPLICATION_MEASURES: dict[str, str] = {
    "Driving Test Applications Received": "applications_received",
    "Driving Test Applicants Waiting at Month End": "applicants_waiting",
    "Driving Test Applicants Scheduled at Month End": "applicants_scheduled",
    "Driving Test Applicants Paused at Month End": "applicants_paused",
    "Driving Test Applicants Not Eligible at Month End": "applicants_not_eligible",
}

# Statistic labels of the county file (county x category).
COUNTY_TEST_MEASURES: dict[str, str] = {
    "Driving Tests Delivered": "tests_delivered",
    "Driving Test Pass Rate": "pass_rate",
    "Driving Test No-Shows": "no_shows",
}

# Statistic labels of the tests cube (centre x category).
CENTRE_TEST_MEASURES: dict[str, str] = {
    "Driving Tests Delivered": "tests_delivered",
    "Driving Test Pass Rate": "pass_rate",
    "Driving Test No-Shows": "no_shows",
    "Driving Tests Not Conducted / Abandoned": "notconducted_or_abandoned",
}

NATIONAL_CENTRE_LABEL = "All driving test centres"   # centre-level national total
NATIONAL_COUNTY_LABEL = "Ireland"                     # county assigned to it
EXCLUDED_COUNTIES = ("ireland",)                      # compared in lower case
EXCLUDED_CATEGORIES = ("all test categories",)        # compared in lower case
HEADER_LABEL = "Statistic Label"                      # header cell of the county file
UNIT_LABEL = "Number"                                 # constant unit on the cube path
UNKNOWN_LABEL = "Unknown"                             # cube cell beyond a label list
ACCEPTED_YEARS = ("2018", "2019", "2020", "2021", "2022", "2023", "2024")

COUNTY_FROM_CENTRE_PATTERN = r",\s*(Co\.\s*\w+)"
COUNTY_PREFIX_PATTERN = r"^Co\.?\s+"
EDGE_WHITESPACE_PATTERN = r"^\s+|\s+$"

# Month spellings accepted by the facts: short and full English names.
MONTH_NUMBERS: dict[str, int] = {
    "jan": 1, "january": 1,
    "feb": 2, "february": 2,
    "mar": 3, "march": 3,
    "apr": 4, "april": 4,
    "may": 5,
    "jun": 6, "june": 6,
    "jul": 7, "july": 7,
    "aug": 8, "august": 8,
    "sep": 9, "september": 9,
    "oct": 10, "october": 10,
    "nov": 11, "november": 11,
    "dec": 12, "december": 12,
}

# Cube dimension -> landing column naming rule inputs.
CUBE_STATISTIC_ID = "STATISTIC"
CUBE_STATISTIC_COLUMN = "Statistic"
CUBE_CENTRE_COLUMN = "Driving Test Centre"
CUBE_CATEGORY_COLUMN = "Driving Test Categories"

# ---------------------------------------------------------------------------
# Landing schemas (headerless CSV, by position).
# ---------------------------------------------------------------------------


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


# Applications / tests cube at centre x category. VALUE is declared 64-bit:
# a 32-bit column would turn any count above 2^31 into NULL under PERMISSIVE.
LANDING_CENTRE_SCHEMA = T.StructType(
    _strings("Statistic", "Month", "Driving Test Categories", "Driving Test Centre", "UNIT")
    + [T.StructField("VALUE", T.LongType(), True)]
)

# Cube without the category dimension.
LANDING_CENTRE_NO_CATEGORY_SCHEMA = T.StructType(
    _strings("Statistic", "Month", "Driving Test Centre", "UNIT")
    + [T.StructField("VALUE", T.LongType(), True)]
)

# County file.
LANDING_COUNTY_SCHEMA = T.StructType(
    _strings("Statistic Label", "Month", "County", "Driving Test Categories", "UNIT")
    + [T.StructField("VALUE", T.DoubleType(), True)]
)

# ---------------------------------------------------------------------------
# Warehouse (raw) schemas: snake_case names, value widened to bigint / double.
# ---------------------------------------------------------------------------

RAW_CENTRE_SCHEMA = T.StructType(
    _strings("statistic", "month", "driving_test_categories", "driving_test_centre", "unit")
    + [T.StructField("value", T.LongType(), True)]
)

RAW_CENTRE_NO_CATEGORY_SCHEMA = T.StructType(
    _strings("statistic", "month", "driving_test_centre", "unit")
    + [T.StructField("value", T.LongType(), True)]
)

RAW_COUNTY_SCHEMA = T.StructType(
    _strings("statistic_label", "month", "county", "driving_test_categories", "unit")
    + [T.StructField("value", T.DoubleType(), True)]
)

# JSON-stat 2.0 document, as far as the reader uses it.
JSONSTAT_SCHEMA = T.StructType([
    T.StructField("result", T.StructType([
        T.StructField("id", T.ArrayType(T.StringType()), True),
        T.StructField("size", T.ArrayType(T.LongType()), True),
        T.StructField("dimension", T.MapType(T.StringType(), T.StructType([
            T.StructField("label", T.StringType(), True),
            T.StructField("category", T.StructType([
                T.StructField("label", T.MapType(T.StringType(), T.StringType()), True),
            ]), True),
        ])), True),
        T.StructField("value", T.ArrayType(T.DoubleType()), True),
    ]), True),
])

# The same with ``value`` in either form (array or object by position), untyped.
CELLS_SCHEMA = T.StructType([T.StructField("result", T.StructType([
    T.StructField("value", T.VariantType(), True) if f.name == "value" else f
    for f in JSONSTAT_SCHEMA["result"].dataType.fields]), True)])

# Grain keys of the two facts (aggregate keys == join keys, see facts.py).
COUNTY_KEYS = ["year", "month", "county", "test_category"]
CENTRE_KEYS = ["year", "month", "county", "test_centre", "test_category"]


def snake_case(name: str) -> str:
    """Landing column name -> warehouse column name (spaces to '_', lower)."""
    return "_".join(name.strip().split()).lower()
