"""The corpus pipeline: each stage on what the one before kept, against plain
Python; edge rows and an empty table."""

import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as C
from cubewise.llm import langid_crf, pii, simhash

FIXTURE = "/root/testdata/sf0.001"


def write(spark, rows, path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{path}/documents.parquet")
    return str(path)


EDGES = [(900_001, None, "en", "s", None), (900_002, "", None, None, 0), (900_003, "12 34 !", "en", "s", 7),
         (None, "Rows without an id stay.", "en", "s", 24), (900_004, "call 499-555-6503 " + "the of and " * 9000, "en", "s", 1),
         (900_007, "Быстрая коричневая лиса прыгает через ленивую собаку и снова", None, "s", 60),
         (900_005, "x  y", "en", "s", 4), (900_005, "x  y", "en", "s", 4), (900_006, "x y", "en", "s", 3)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rows = [tuple(r) for r in spark.read.parquet(f"{FIXTURE}/documents.parquet").collect()] + EDGES
    path = write(spark, rows, tmp_path_factory.mktemp("documents"))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = [("documents", docs.collect())]
    columns = docs.columns
    for n, (name, stage) in enumerate(C.STAGES):
        docs = stage(spark, docs, path)
        assert n == len(C.STAGES) - 1 or docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append((name, docs.collect()))
    return out


def test_language(stages):
    before, after = stages[0][1], stages[1][1]
    expected = [r for r in before if langid_crf.words_of(r["text"] or "") and r["doc_id"] != 900_007]
    assert sorted(map(str, after)) == sorted(map(str, expected))


def test_exact(stages):
    before, after = stages[1][1], stages[2][1]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub("[ \t-\r]+", " ", r["text"])].append(r["doc_id"] if r["doc_id"] is not None else 1 << 62)
    expected = sorted(min(ids) for ids in groups.values())
    assert sorted(r["doc_id"] if r["doc_id"] is not None else 1 << 62 for r in after) == expected


def test_near(stages):
    before, after = stages[2][1], stages[3][1]
    fps = [simhash.fingerprint(r["text"]) for r in before]
    ids = [r["doc_id"] if r["doc_id"] is not None else 1 << 62 for r in before]
    group = list(range(len(fps)))
    for _ in fps:
        new = [min(group[j] for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= 2) for i in range(len(fps))]
        if new == group:
            break
        group = new
    expected = sorted({min(ids[i] for i in range(len(ids)) if group[i] == g) for g in set(group)})
    assert sorted(r["doc_id"] if r["doc_id"] is not None else 1 << 62 for r in after) == expected


def test_private(stages):
    before, after = ({r["doc_id"]: r for r in stages[n][1]} for n in (3, 4))
    assert before.keys() == after.keys()
    for i, r in before.items():
        found = list(pii.entities(r["text"]))
        assert (after[i]["text"] == r["text"]) == (not found)
        if found:
            assert after[i]["n_chars"] == len(after[i]["text"])
            assert not any(r["text"][a:b] in after[i]["text"] for _, _, a, b in found)
        else:
            assert after[i] == r


def test_packed(stages):
    docs, pieces = stages[4][1], stages[5][1]
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in docs}
    places = defaultdict(list)
    for p in pieces:
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in places.values():
        assert [o for o, _ in sorted(spans)] == [0, *np.cumsum([n for _, n in sorted(spans)]).tolist()][:-1]


def test_run_gives_the_last_stage(spark, stages, tmp_path):
    path = write(spark, [tuple(r) for r in stages[0][1]], tmp_path)
    assert C.run(spark, path).count() == len(stages[5][1])


def test_empty_table(spark, tmp_path):
    assert C.run(spark, write(spark, [], tmp_path)).collect() == []
