"""Landing CSV that keeps text, batch order, rejected documents, filters below
the join and months that are none."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from cubewise.functions import month_number, month_start
from cubewise.plans.facts import county_fact
from cubewise.plans.landing import RejectedDocuments, land_cube
from cubewise.schemas import LANDING_CENTRE_NO_CATEGORY_SCHEMA, RAW_CENTRE_NO_CATEGORY_SCHEMA
from cubewise.sinks.files import land_csv, load_raw
from cubewise.sources.csv import read_landing_csv

LABELS = ['say "B", ok', " B ", "", None, "a\nb\r\nc", "\x01", "\x011", "\\N x", "back\\slash", "tab\t", "'q'", '"', ",", "\\"]


def rows_of(spark, labels, value=1):
    return spark.createDataFrame([("s", "2021 January", c, "Number", value) for c in labels],
                                 RAW_CENTRE_NO_CATEGORY_SCHEMA)


def load(spark, landing, tmp_path, **options):
    return load_raw(spark, f"{landing}/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, str(tmp_path / "raw"),
                    RAW_CENTRE_NO_CATEGORY_SCHEMA, **options)


def test_texts_survive_landing(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land_csv(rows_of(spark, LABELS), landing)
    got = [r["driving_test_centre"] for r in load(spark, landing, tmp_path).collect()]
    assert sorted(got, key=str) == sorted(LABELS, key=str)


def test_doubled_quotes_of_other_writers(spark, tmp_path):
    path = tmp_path / "file.csv"
    path.write_text('s,2021 January,"say ""B"", ok",Number,3\ns,2021 January,,Number,4\ns,2021 January,"",Number,5\n')
    got = read_landing_csv(spark, str(path), LANDING_CENTRE_NO_CATEGORY_SCHEMA).collect()
    assert [(r[2], r[4]) for r in got] == [('say "B", ok', 3), (None, 4), ("", 5)]


def test_latest_batch_beats_older_and_unbatched_files(spark, tmp_path):
    landing = str(tmp_path / "landing_apps")
    land_csv(rows_of(spark, ["A", "B"], 1), landing)
    land_csv(rows_of(spark, ["A"], 7), landing, batch="0002")
    land_csv(rows_of(spark, ["A"], 4), landing, batch="0010")
    keys = ["statistic", "month", "driving_test_centre"]
    got = load(spark, landing, tmp_path, latest_wins=keys).collect()
    assert sorted((r["driving_test_centre"], r["value"]) for r in got) == [("A", 4), ("B", 1)]


def test_months_that_are_none(spark):
    df = spark.createDataFrame([("123",), ("1200",), ("13",), ("0",), ("-1",), ("12",), ("Jan",)], "m string")
    got = [r[0] for r in df.select(month_start(F.lit("2021"), month_number("m"))).collect()]
    assert got == [None] * 5 + [datetime.date(2021, 12, 1), datetime.date(2021, 1, 1)]


def test_rejected_documents_fail_and_are_all_listed(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for n in range(8):
        (docs / f"{n}.json").write_text(json.dumps({"result": {"id": [], "size": []}}))
    with pytest.raises(RejectedDocuments, match="8 documents"):
        land_cube(spark, f"{docs}/*.json", str(tmp_path / "landing"))
    assert not (tmp_path / "landing").exists()
    assert spark.read.json(str(tmp_path / "landing_rejected")).count() == 8


def test_filters_run_below_the_join(spark):
    api = spark.createDataFrame([], "statistic string, year string, month string, test_category string, "
                                    "test_centre_raw string, county string, unit bigint")
    local = spark.createDataFrame([], "statistic_label string, year string, month string, county string, "
                                      "driving_test_categories string, unit string, value double")
    fact = county_fact(api, local, year="2020", month=[1, 2], category="B")
    plan = fact._jdf.queryExecution().analyzed().toString()
    above, below = plan.split("Join FullOuter", 1)
    assert "2020" not in above and below.count("2020") == 2
    assert below.index("Aggregate") < below.index("2020")
