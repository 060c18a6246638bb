"""One document's cells parsed by many tasks: the rows of the reader of whole documents."""

import json
import random

import pytest

from cubewise.sources.jsonstat import read_jsonstat
from cubewise.sources.jsonstat_split import read_jsonstat_split, store_tokens

COLUMNS = ["Statistic", "Month"]


def doc(value, size=(2, 3), **more):
    label = {"STATISTIC": ("Stat, \"value\":[1] of", {"s1": "First, [a]", "s2": "Zweitér \\"}),
             "T": ("Month", {"m1": "2021 January", "m2": "2021 February", "m3": "2021 March"})}
    return {"jsonrpc": "2.0", "result": {
        "class": "dataset", "id": list(label), "size": list(size),
        "dimension": {k: {"label": n, "category": {"index": list(c), "label": c}} for k, (n, c) in label.items()},
        "value": value, "extension": {"units]": ["x", "y]"]}, **more}}


@pytest.fixture
def landed(spark, tmp_path):
    """Texts, one a file -> both readers' rows and rejects, by byte ranges of ``most`` bytes."""
    def run(texts, most=150, chunk=4):
        for n, text in enumerate(texts):
            (tmp_path / f"{n:03d} ü.json").write_text(text, encoding="utf-8")
        key = "spark.sql.files.maxPartitionBytes"
        before = spark.conf.get(key)
        spark.conf.set(key, str(most))
        try:
            split = [sorted(map(str, d.collect())) for d in read_jsonstat_split(spark, str(tmp_path), COLUMNS, chunk)]
        finally:
            spark.conf.set(key, before)
        whole = [sorted(map(str, d.collect())) for d in read_jsonstat(spark, str(tmp_path), COLUMNS)]
        return split, whole
    return run


def test_ranges_of_any_size_give_the_rows_of_whole_documents(landed):
    cells = [[1, None, 2.9, -2.9, 5e3, 6], [], [7], list(range(9)), [0.5] * 6, [float("nan"), 1, 2]]
    texts = [json.dumps(doc(v), indent=n % 3 or None, ensure_ascii=n % 2 == 0) for n, v in enumerate(cells)]
    texts.append(json.dumps(doc([1, 2], size=(1, 2)), separators=(",", ":")))
    for most, chunk in ((48, 4), (1 << 20, 1 << 16)):
        split, whole = landed(texts, most, chunk)
        assert split == whole and len(split[0]) == 6 + 1 + 6 + 6 + 3 + 2 and not split[1]


def test_a_cube_is_read_by_many_tasks(spark, tmp_path, landed):
    rng = random.Random(5)
    split, whole = landed([json.dumps(doc([rng.randrange(1000) for _ in range(5000)], size=(50, 100)))], most=2000, chunk=64)
    assert split == whole and len(split[0]) == 5000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert store_tokens(spark, str(tmp_path)).select("block").distinct().count() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_documents_that_cannot_be_read_are_named(landed):
    texts = ["", "[]", "{", json.dumps(doc(["1", 2])), json.dumps(doc({"0": 1})), json.dumps(doc([1, True, 3])),
             json.dumps(doc([1, 2], note={"value": [1]})), json.dumps(doc([1, 2])).partition(", 2]")[0], '{"result":{"value":[1,2',
             json.dumps(doc([1, 2], size=(2,))), json.dumps(doc([1, [2], 3])), '{"a":1,"value":[1,2]}', json.dumps(doc([1, 2]))]
    split, whole = landed(texts)
    reasons = [r.split("reject_reason='")[1][:-2] for r in split[1]]
    assert split[0] == [r for r in whole[0] if "/012" in r]
    assert reasons == ["no array of values", "no array of values", "malformed-document", "no array of values",
                       "malformed-document", "several arrays of values", "values end too early", "values end too early",
                       "dimension order and size differ in length", "malformed-document", "missing result"]
