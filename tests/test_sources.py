"""JSON-stat reader and builder, CSV landing and loading."""

import json
import os

from pyspark.sql import functions as F

from cubewise.operators.project import to_snake_case
from cubewise.plans.cube_docs import cube_documents
from cubewise.plans.landing import land_county_file, load_county_raw
from cubewise.schemas import LANDING_CENTRE_SCHEMA, LANDING_COUNTY_SCHEMA, RAW_CENTRE_SCHEMA
from cubewise.session import scratch_path
from cubewise.sinks.files import land_csv, load_raw, materialize, preview
from cubewise.sources.csv import clean_csv_rows, read_landing_csv
from cubewise.sources.jsonstat import (
    CENTRE_COLUMNS,
    flatten_cube,
    parse_documents,
    read_jsonstat,
    validate_jsonstat,
)


def cube(values, stat_labels=("s0", "s1"), month_labels=("m0", "m1"), centre_labels=("c0", "c1")):
    dims = {
        "STATISTIC": {"label": "Statistic", "category": {"label": {f"k{i}": v for i, v in enumerate(stat_labels)}}},
        "TLIST(M1)": {"label": "Month", "category": {"label": {f"k{i}": v for i, v in enumerate(month_labels)}}},
        "C02": {"label": "Driving Test Centre",
                         "category": {"label": {f"k{i}": v for i, v in enumerate(centre_labels)}}},
    }
    return {"result": {"id": list(dims), "size": [2, 2, 2], "dimension": dims, "value": values}}


def flatten(spark, docs, columns=("Statistic", "Month", "Driving Test Centre")):
    df = spark.createDataFrame([(f"d{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)],
                               "doc string, json string")
    valid, rejected = validate_jsonstat(parse_documents(df))
    return flatten_cube(valid, list(columns)), rejected


def test_row_major_order_and_values(spark):
    rows, rej = flatten(spark, [cube([1, 2, 3, 4, 5, 6, 7, 8])])
    got = [(r.Statistic, r.Month, r["Driving Test Centre"], r.VALUE) for r in rows.orderBy("VALUE").collect()]
    assert got[0] == ("s0", "m0", "c0", 1)
    assert got[1] == ("s0", "m0", "c1", 2)      # last dimension fastest
    assert got[2] == ("s0", "m1", "c0", 3)
    assert got[7] == ("s1", "m1", "c1", 8)
    assert rej.count() == 0
    assert set(r.UNIT for r in rows.collect()) == {"Number"}


def test_short_and_long_value_arrays(spark):
    short, _ = flatten(spark, [cube([1, 2, 3, 4, 5, 6, 7])])
    long_, _ = flatten(spark, [cube([1, 2, 3, 4, 5, 6, 7, 8, 9])])
    assert short.count() == 7 and long_.count() == 8


def test_null_nan_and_truncation(spark):
    text = json.dumps(cube([None, 1.0, 2.9, -2.9, 5, 6, 7, 8])).replace("1.0", "NaN")
    rows, _ = flatten(spark, [text])
    vals = [r.VALUE for r in rows.orderBy("Statistic", "Month", "Driving Test Centre").collect()]
    assert vals[:4] == [0, 0, 2, -2]


def test_missing_label_and_document_order(spark):
    rows, _ = flatten(spark, [cube(list(range(8)), centre_labels=("zeta", ), stat_labels=("b", "a"))])
    got = {(r.Statistic, r["Driving Test Centre"], r.VALUE) for r in rows.collect()}
    assert ("b", "zeta", 0) in got and ("b", "Unknown", 1) in got   # past the end -> Unknown
    assert ("a", "zeta", 4) in got                                    # document order, not sorted


def test_rejected_documents(spark):
    bad_text_cell = json.dumps(cube([1, 2, "..", 4, 5, 6, 7, 8]))
    object_value = json.dumps(cube({"0": 1, "1": 2}))
    no_result = json.dumps({"error": "x"})
    no_id = cube([1] * 8)
    no_id["result"]["id"] = []
    missing_dim = cube([1] * 8)
    del missing_dim["result"]["dimension"]["TLIST(M1)"]
    rows, rej = flatten(spark, [bad_text_cell, object_value, no_result, no_id, missing_dim, "not json",
                                cube([1] * 8)])
    reasons = {r.doc: r.reject_reason for r in rej.collect()}
    assert set(reasons) == {"d0", "d1", "d2", "d3", "d4", "d5"}
    assert reasons["d2"] == "missing result" and reasons["d3"] == "no-dimension-order"
    assert rows.count() == 8


def test_column_naming_rule(spark):
    doc = cube(list(range(8)))
    doc["result"]["dimension"]["C01"] = doc["result"]["dimension"].pop("C02")
    doc["result"]["dimension"]["C01"]["label"] = "Driving Test Categories"
    doc["result"]["id"][2] = "C01"
    rows, _ = flatten(spark, [doc], CENTRE_COLUMNS)
    r = rows.collect()[0]
    assert r["Driving Test Categories"] == "c0" and r["Driving Test Centre"] is None


def test_builder_round_trip(spark):
    long_rows = spark.createDataFrame([
        (1, "S1", "2021 January", "B", "A, Co. X"),
        (1, "S1", "2021 January", "B", "A, Co. X"),
        (1, "S2", "2021 March", "C", "A, Co. X"),
        (2, "S1", "2021 January", "B", "Z, Co. Y"),
    ], "n_nationkey int, statistic string, month string, driving_test_categories string, "
       "driving_test_centre string")
    docs = cube_documents(long_rows)
    assert docs.count() == 2
    path = scratch_path(spark, "test_cubes")
    docs.select("json").write.text(path)
    rows, rej = read_jsonstat(spark, path, CENTRE_COLUMNS, layout="lines")
    got = {(r.Statistic, r.Month, r["Driving Test Categories"], r["Driving Test Centre"]): r.VALUE
           for r in rows.collect()}
    assert rej.count() == 0
    assert len(got) == 2 * 2 * 2 * 1 + 1         # nation 1: 2x2x2x1 cells, nation 2: 1
    assert got[("S1", "2021 January", "B", "A, Co. X")] == 2
    assert got[("S2", "2021 January", "B", "A, Co. X")] == 0   # empty cell -> 0


def test_county_file_landing_and_load(spark, tmp_path):
    src = tmp_path / "county.csv"
    src.write_text("Statistic Label,Month,County,Driving Test Categories,UNIT,VALUE\n"
                   "Driving Tests Delivered,2021 January,Co. Cork,B,Number,5\n"
                   ",2021 January,Co. Cork,B,Number,5\n"
                   "Driving Test Pass Rate,2021 January,Co. Cork,B,Number,\n"
                   "Driving Test No-Shows,2021 January,Co. Cork,B,Number,abc\n")
    landing = scratch_path(spark, "test_landing")
    land_county_file(spark, str(src), landing)
    land_county_file(spark, str(src), landing)          # append: second batch adds rows
    loaded = load_county_raw(spark, landing, scratch_path(spark, "test_raw"))
    assert loaded.columns == ["statistic_label", "month", "county", "driving_test_categories", "unit", "value"]
    rows = loaded.collect()
    assert len(rows) == 6
    assert sorted({r.value for r in rows}) == [0.0, 5.0]


def test_load_raw_is_full_refresh(spark):
    df = spark.createDataFrame([("S", "2021 January", "B", "A, Co. X", "Number", 3)],
                               LANDING_CENTRE_SCHEMA)
    landing = scratch_path(spark, "test_landing_api")
    land_csv(df, landing)
    target = scratch_path(spark, "test_raw_api")
    load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, target, RAW_CENTRE_SCHEMA)
    out = load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, target, RAW_CENTRE_SCHEMA)
    assert out.count() == 1
    assert out.schema == RAW_CENTRE_SCHEMA


def test_header_rows_and_corrupt_records(spark, tmp_path):
    src = tmp_path / "c.csv"
    src.write_text("Statistic Label,Month,County,Driving Test Categories,UNIT,VALUE\nA,m,c,k,u,1.5\nB,m,c,k,u,x\n")
    raw = read_landing_csv(spark, str(src), LANDING_COUNTY_SCHEMA, corrupt_col="_corrupt")
    bad = [r for r in raw.collect() if r["_corrupt"] is not None]   # all columns parsed
    assert len(bad) == 2    # header + unparseable value
    cleaned = clean_csv_rows(raw.drop("_corrupt"), "Statistic Label", "VALUE")
    assert sorted((r["Statistic Label"], r.VALUE) for r in cleaned.collect()) == [("A", 1.5), ("B", 0.0)]


def test_materialize_partitions_by_year(spark):
    df = spark.createDataFrame([("2021", 1), ("2022", 2), ("2022", 3)], "year string, v int")
    target = scratch_path(spark, "test_fact")
    out = materialize(df, target)
    parts = sorted(p for p in os.listdir(target.replace("file:", "")) if p.startswith("year="))
    assert parts == ["year=2021", "year=2022"]
    assert out.count() == 3
    assert preview(out, 2).count() == 2
    assert to_snake_case(spark.createDataFrame([(1,)], "`Driving Test Centre` int")).columns == [
        "driving_test_centre"]


def test_land_cube_raises_on_rejected_documents(spark, tmp_path):
    import pytest

    from cubewise.plans.landing import RejectedDocuments, land_cube

    (tmp_path / "good.json").write_text(json.dumps(cube([1] * 8)))
    (tmp_path / "bad.json").write_text(json.dumps({"error": "no result"}))
    with pytest.raises(RejectedDocuments):
        land_cube(spark, str(tmp_path), scratch_path(spark, "t_land"), fail_on_reject=True)
    landing = scratch_path(spark, "t_land")
    rejected = land_cube(spark, str(tmp_path), landing, ["Statistic", "Month", "Driving Test Centre"],
                         fail_on_reject=False)
    assert [r.reject_reason for r in rejected.collect()] == ["missing result"]
    assert len(spark.read.csv(landing).collect()) == 8


def test_single_file_landing(spark):
    df = spark.range(100).selectExpr("cast(id as string) as a", "id as b").repartition(4)
    landing = scratch_path(spark, "t_single")
    land_csv(df, landing, single_file=True)
    parts = [p for p in os.listdir(landing) if p.startswith("part-")]
    assert len(parts) == 1
    assert spark.read.csv(landing).count() == 100


def test_rebalanced_flatten_keeps_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(cube(list(range(8)))))
    rows, _ = read_jsonstat(spark, str(tmp_path), ["Statistic", "Month", "Driving Test Centre"],
                            rebalance=True)
    assert sorted(r.VALUE for r in rows.collect()) == list(range(8))


def test_cube_without_category_lands_and_stages(spark, tmp_path):
    from cubewise.plans.landing import land_cube
    from cubewise.plans.staging import stage_centre_stats
    from cubewise.schemas import LANDING_CENTRE_NO_CATEGORY_SCHEMA, RAW_CENTRE_NO_CATEGORY_SCHEMA
    from cubewise.sources.jsonstat import CENTRE_NO_CATEGORY_COLUMNS

    doc = cube([1, 2, 3, 4, 5, 6, 7, 8], month_labels=("2021 January", "2021 Feb"),
               centre_labels=("Tuam, Co. Galway", "Finglas"))
    (tmp_path / "r.json").write_text(json.dumps(doc))
    landing = scratch_path(spark, "t_ro34")
    land_cube(spark, str(tmp_path), landing, CENTRE_NO_CATEGORY_COLUMNS)
    raw = load_raw(spark, landing + "/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, scratch_path(spark, "t_ro34_raw"),
                   RAW_CENTRE_NO_CATEGORY_SCHEMA)
    stg = stage_centre_stats(raw, has_category=False)
    assert stg.columns == ["statistic", "year", "month", "test_centre_raw", "county", "unit"]
    got = {(r.statistic, r.month, r.county, r.unit) for r in stg.collect()}
    assert ("s0", "January", "Co. Galway", 1) in got and ("s1", "Feb", None, 8) in got


def test_latest_batch_wins_on_reingest(spark):
    rows = [("S1", "2021 January", "B", "A, Co. X", "Number", 1),
            ("S1", "2021 January", "B", "A, Co. X", "Number", 2),
            ("S2", "2021 January", "B", "A, Co. X", "Number", 5)]
    landing = scratch_path(spark, "t_batches")
    land_csv(spark.createDataFrame(rows, LANDING_CENTRE_SCHEMA), landing, batch="0001")
    revised = [("S1", "2021 January", "B", "A, Co. X", "Number", 7)]
    land_csv(spark.createDataFrame(revised, LANDING_CENTRE_SCHEMA), landing, batch="0002")
    out = load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, scratch_path(spark, "t_latest"),
                   RAW_CENTRE_SCHEMA,
                   latest_wins=["statistic", "month", "driving_test_categories", "driving_test_centre"])
    assert out.columns == RAW_CENTRE_SCHEMA.fieldNames()
    assert sorted((r.statistic, r.value) for r in out.collect()) == [("S1", 7), ("S2", 5)]
    plain = load_raw(spark, landing + "/*", LANDING_CENTRE_SCHEMA, scratch_path(spark, "t_all"),
                     RAW_CENTRE_SCHEMA)
    assert plain.count() == 4


def test_materialize_keeps_declared_partition_types(spark):
    df = spark.createDataFrame([("2021", 1), ("2022", 2)], "year string, v int")
    out = materialize(df, scratch_path(spark, "t_types"))
    assert dict(out.dtypes)["year"] == "string"
    assert out.filter("year = '2021'").count() == 1


def test_documents_are_parsed_once_a_pass(spark, tmp_path):
    (tmp_path / "cubes").write_text('{"result": null}\n')
    for df in read_jsonstat(spark, str(tmp_path / "cubes"), layout="lines"):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
