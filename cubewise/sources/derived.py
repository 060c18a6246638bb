"""Raw statistics tables derived from the driver's TPC-H-style tables.

The statistics tables the pipeline was written for are not shipped, so the
raw inputs are built from ``orders``, ``lineitem``, ``customer`` and
``nation`` by fixed rules; their size grows with the source tables.

* raw_api (applications, centre x category): one row per order.
* raw_ro30 (tests, centre x category): one row per line item; open lines are
  booked tests, a statistic that no measure counts.
* raw_ro34 (tests, centre only): raw_ro30 without the category.
* raw_county (county file, county x category): one row per line item, with the file's own defects (NULL labels, NULL values).

Rules (identical in the SQL oracle):
  period      = (year + 23) and the month, spelt per row (see ``_period``)
  centre      = 'Centre <custkey % 7>, Co. <nation>'; nation 0 is the
                national total, nation 1 has no county, nation 2 no space
  category    = market segment ('All Test Categories' for open household
                orders on the applications side)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubewise.schemas import NATIONAL_CENTRE_LABEL, NATIONAL_COUNTY_LABEL, UNIT_LABEL
from cubewise.session import table_path

YEAR_SHIFT = 23  # 1995..2001 -> 2018..2024
BOOKED = "Driving Tests Booked"  # matches no measure
CUBE_CUSTOMERS = 500  # customers per block of cubes, so that their number follows the table


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table as its files are now."""
    return spark.read.parquet(path)


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str, where=None) -> DataFrame:
    """Pruned (and filtered) scan: Catalyst pushes both into the Parquet reader."""
    df = read_table(spark, table_path(sf_dir, name)).select(*cols)
    return df if where is None else df.filter(where)


def customer_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey -> market segment, nation, centre label.

    ``nation`` has 25 rows by definition of the schema, so broadcasting it is
    bounded; customer itself is left to the planner's size estimate.
    """
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
    slot = (F.col("c_custkey") % 7).cast("string")
    centre = (
        F.when(F.col("n_nationkey") == 0, F.lit(NATIONAL_CENTRE_LABEL))
        .when(F.col("n_nationkey") == 1, F.concat(F.lit("Centre "), slot))
        .when(F.col("n_nationkey") == 2, F.concat(F.lit("Centre "), slot, F.lit(", Co."), F.col("n_name")))
        .otherwise(F.concat(F.lit("Centre "), slot, F.lit(", Co. "), F.col("n_name")))
    )
    county = (F.when(F.col("n_nationkey") == 0, F.lit(NATIONAL_COUNTY_LABEL))
              .otherwise(F.concat(F.lit("Co. "), F.col("n_name"))))
    return j.select("c_custkey", "c_mktsegment", "n_nationkey", "n_name",
                    centre.alias("centre"), county.alias("county_label"))


def _year(d: Column) -> Column:
    return (F.year(d) + YEAR_SHIFT).cast("string")


def period_full(d: Column) -> Column:
    """'2021 January'."""
    return F.concat(_year(d), F.lit(" "), F.date_format(d, "MMMM"))


def _period(d: Column, status: Column, priority: Column, key: Column) -> Column:
    """Month spelling of an application row. Finished and open orders use
    the full name; pending orders vary it by priority: short name, upper-case
    short name, number (for some keys one that is no month), a code without a
    space (unparseable), full name."""
    y = _year(d)
    number = (F.when(key % 10 == 0, F.lit("123")).when(key % 10 == 1, F.lit("13")).when(key % 10 == 2, F.lit("0"))
              .otherwise(F.month(d).cast("string")))
    return (
        F.when(status != F.lit("P"), period_full(d))
        .when(priority == F.lit("1-URGENT"), F.concat(y, F.lit(" "), F.date_format(d, "MMM")))
        .when(priority == F.lit("2-HIGH"), F.concat(y, F.lit(" "), F.upper(F.date_format(d, "MMM"))))
        .when(priority == F.lit("3-MEDIUM"), F.concat(y, F.lit(" "), number))
        .when(priority == F.lit("4-NOT SPECIFIED"),
              F.concat(y, F.lit("M"), F.lpad(F.month(d).cast("string"), 2, "0")))
        .otherwise(period_full(d))
    )


def raw_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications table (statistic, month, driving_test_categories,
    driving_test_centre, unit, value bigint)."""
    return applications(spark, sf_dir).drop("n_nationkey", "doc_block")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_api rows plus the nation key of their centre and the block of
    customers whose cubes hold them."""
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
              "o_orderpriority")
    c = customer_centres(spark, sf_dir)
    j = o.join(c, o.o_custkey == c.c_custkey)
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    statistic = (
        F.when(prio == "1-URGENT", F.lit("Driving Test Applications Received"))
        .when(prio == "2-HIGH", F.lit("Driving Test Applicants Waiting at Month End"))
        .when(prio == "3-MEDIUM", F.lit("Driving Test Applicants Scheduled at Month End"))
        .when(prio == "4-NOT SPECIFIED", F.lit("Driving Test Applicants Paused at Month End"))
        .when(status == "F", F.lit("Driving Test Applicants Deferred"))  # matches no measure
        .otherwise(F.lit("Driving Test Applicants Not Eligible at Month End"))
    )
    category = (F.when((F.col("c_mktsegment") == "HOUSEHOLD") & (status == "O"), F.lit("All Test Categories"))
                .otherwise(F.col("c_mktsegment")))
    return j.select(
        statistic.alias("statistic"),
        _period(F.col("o_orderdate"), status, prio, F.col("o_orderkey")).alias("month"),
        category.alias("driving_test_categories"),
        F.col("centre").alias("driving_test_centre"),
        F.lit(UNIT_LABEL).alias("unit"),
        F.col("o_orderkey").alias("value"),
        F.col("n_nationkey"),
        F.expr(f"o_custkey div {CUBE_CUSTOMERS}").alias("doc_block"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their customer's centre. Orders and customers are joined
    first, so that the largest table crosses one exchange only."""
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = customer_centres(spark, sf_dir)
    placed = o.join(c, o.o_custkey == c.c_custkey)
    return li.join(placed, li.l_orderkey == placed.o_orderkey).select(
        "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate", "c_mktsegment", "centre", "county_label")


def raw_ro30(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """Tests table at centre x category (same columns as raw_api). ``joined``: the rows
    of ``lines``, where several tables are made of them."""
    j = lines(spark, sf_dir) if joined is None else joined
    flag = F.col("l_returnflag")
    statistic = (
        F.when(F.col("l_linestatus") == "O", F.lit(BOOKED))
        .when(F.col("l_quantity") > 45, F.lit("Driving Tests Not Conducted / Abandoned"))
        .when(flag == "R", F.lit("Driving Tests Delivered"))
        .when(flag == "A", F.lit("Driving Test Pass Rate"))
        .otherwise(F.lit("Driving Test No-Shows"))
    )
    return j.select(
        statistic.alias("statistic"),
        period_full(F.col("l_shipdate")).alias("month"),
        F.col("c_mktsegment").alias("driving_test_categories"),
        F.col("centre").alias("driving_test_centre"),
        F.lit(UNIT_LABEL).alias("unit"),
        F.col("l_orderkey").alias("value"),
    )


def raw_ro34(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """Tests table at centre grain only (no category column)."""
    return raw_ro30(spark, sf_dir, joined).drop("driving_test_categories")


def raw_county(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """County file rows as read from the file (before landing): a NULL label
    for single-unit lines and a NULL value for lines above 48 units."""
    j = lines(spark, sf_dir) if joined is None else joined
    flag = F.col("l_returnflag")
    label = (
        F.when(F.col("l_quantity") == 1, F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "O", F.lit(BOOKED))
        .when(flag == "R", F.lit("Driving Tests Delivered"))
        .when(flag == "A", F.lit("Driving Test Pass Rate"))
        .otherwise(F.lit("Driving Test No-Shows"))
    )
    value = F.when(F.col("l_quantity") > 48, F.lit(None).cast("double")).otherwise(F.col("l_quantity"))
    return j.select(
        label.alias("statistic_label"),
        period_full(F.col("l_shipdate")).alias("month"),
        F.col("county_label").alias("county"),
        F.col("c_mktsegment").alias("driving_test_categories"),
        F.lit(UNIT_LABEL).alias("unit"),
        value.alias("value"),
    )
