"""Every stage returns columns that bear the operators' own names as they came."""

import corpus_pipeline
import pytest

NAMES = ["rank", "_rank", "_sha", "sha", "_text", "text_hash", "entities", "lang_pred", "score", "component", "keep_id", "kept", "_0", "_1", "_entities"]


@pytest.fixture
def docs(spark, docs_of):
    import random

    rng = random.Random(1)
    words = ["the", "house", "and", "river", "over", "stone", "where", "people", "night", "morning"]
    rows = [(n, " ".join(rng.choice(words) for _ in range(30)) + f" call +49 30 12345{n % 3}") for n in range(40)]
    rows += [(100, rows[0][1]), (101, rows[1][1].replace(" ", "  "))]
    plain = docs_of(rows).drop("rank", "body", "fp")
    return plain.selectExpr("*", *[f"doc_id * 1000 + {n} as `{c}`" for n, c in enumerate(NAMES)])


@pytest.mark.parametrize("stage", ["language", "exact", "near", "private"])
def test_extra_columns_stay(spark, docs, stage):
    done = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert done.columns == docs.columns and done.schema.simpleString() == docs.schema.simpleString()
    rows = done.collect()
    assert rows and all(r[c] == r["doc_id"] * 1000 + n for r in rows for n, c in enumerate(NAMES))
