"""Cubes whose value is an object by position, or holds cells that are no figures."""

import json
import re

import pytest

from cubewise.sources.jsonstat import (
    flatten_cells,
    flatten_cube,
    parse_cells,
    parse_documents,
    read_jsonstat_cells,
    validate_jsonstat,
)

COLUMNS = ["Statistic", "Month"]


def doc(value, size=(2, 3)):
    label = {"STATISTIC": ("Statistic", {"s1": "First", "s2": "Second"}),
             "T": ("Month", {"m1": "2021 January", "m2": "2021 February", "m3": "2021 March"})}
    return json.dumps({"result": {"id": list(label), "size": list(size), "value": value,
                                  "dimension": {k: {"label": n, "category": {"label": c}} for k, (n, c) in label.items()}}})


@pytest.fixture
def flat(spark):
    def run(*values):
        docs = spark.createDataFrame([(str(n), doc(v)) for n, v in enumerate(values)], "doc string, json string")
        valid, rejected = validate_jsonstat(parse_cells(docs))
        rows = flatten_cells(valid, COLUMNS).drop("UNIT").collect()
        return sorted(map(tuple, rows), key=str), sorted(map(tuple, rejected.collect()))
    return run


def test_both_forms_give_the_dense_rows(spark, flat):
    dense = [1, None, 2.9, -2.9, 5, 6]
    rows, rejected = flat(dense, {str(n): v for n, v in enumerate(dense)})
    docs = spark.createDataFrame([(n, doc(dense)) for n in "01"], "doc string, json string")
    expected = flatten_cube(validate_jsonstat(parse_documents(docs))[0], COLUMNS).drop("UNIT").collect()
    assert rows == sorted(((*r, None) for r in expected), key=str) and not rejected


def test_text_cells_are_reported_one_by_one(flat):
    rows, rejected = flat([1, "..", True, "7"], {"5": "x", "1": 4, "9": 1, "k": 2, "-1": None})
    assert not rejected
    assert rows == sorted([
        ("0", "First", "2021 January", 1, None), ("0", "First", "2021 February", None, '".."'),
        ("0", "First", "2021 March", None, "true"), ("0", "Second", "2021 January", None, '"7"'),
        ("1", "Second", "2021 March", None, '"x"'), ("1", "First", "2021 February", 4, None),
        ("1", None, None, None, "k: 2"), ("1", None, None, None, "-1: null")], key=str)


def test_short_long_and_empty_values(flat):
    rows, _ = flat([], {}, list(range(9)))
    assert [r[3] for r in rows] == sorted(range(6), key=lambda n: (n // 3, ["February", "January", "March"].index(["January", "February", "March"][n % 3])))


def test_a_value_of_another_kind_is_rejected(flat):
    rows, rejected = flat(5, "text", None)
    assert rows == [] and [r[1] for r in rejected] == ["malformed-document"] * 3


def test_keys_that_look_like_positions(flat):
    keys = {"007": 1, "+1": 2, " 2": 3, "-0": 4, "": 5, "99999999999999999999": 6, "1.0": 7, "4": 8, "٣": 9}
    rows, _ = flat(keys, {"1": 1, "2": None}, {"5": 1, "05": "y", "-3": 2})
    labels = lambda n: (["First", "Second"][n // 3], ["2021 January", "2021 February", "2021 March"][n % 3])
    expected = [("0", *labels(4), 8, None), ("1", *labels(1), 1, None), ("1", *labels(2), 0, None),
                ("2", *labels(5), 1, None), ("2", *labels(5), None, '"y"'), ("2", None, None, None, "-3: 2")]
    expected += [("0", None, None, None, f"{k}: {v}") for k, v in keys.items() if k not in ("007", "4")]
    assert rows == sorted(expected, key=str)


def test_cells_are_generated_code_that_the_jvm_compiles(spark, tmp_path, capfd):
    (tmp_path / "cubes").write_text("\n".join(doc(v) for v in ([1, None, ".."], {"1": 2, "k": None})))
    rows, faults, _ = read_jsonstat_cells(spark, str(tmp_path / "cubes"), COLUMNS, layout="lines")
    assert (rows.count(), faults.count()) == (3, 2)
    for df in (rows, faults):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"\*\(\d+\) Generate posexplode", plan), plan
        assert plan.count("from_json(") == 1
        df.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out)]
        assert sizes and max(sizes) < 8000  # the JVM interprets longer methods
