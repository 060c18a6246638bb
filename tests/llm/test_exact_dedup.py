"""Exact de-duplication against grouping the normalised texts in Python."""

import hashlib
import random
import re

from cubewise.llm import common
from cubewise.llm import exact_dedup as X


def brute(rows):
    norm = [(i, re.sub("[ \t-\r]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for t, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = min(real) if real else None
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


CASES = [
    (5, "a  b\tc"), (3, "a b c"), (4, "a\x0bb\x0cc"), (9, " a b c"), (2, None), (1, ""), (8, " "), (7, "\n\t"),
    (11, "\xa0"), (12, "A b c"), (None, "a b c"), (None, "only"), (None, "only"), (6, "x"), (6, "x"), (6, "y"),
    (20, "long " * 90_000), (21, "long  " * 90_000), (22, "long " * 89_999 + "lonG "), (23, "\x00\x00"), (24, "\x00"),
]


def test_against_brute_force(docs_of):
    assert rows_of(X.deduplicate(docs_of(CASES))) == brute(CASES)


def test_collisions_are_told_apart(docs_of):
    # Tiny fields: nearly every pair of equal length collides.
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 4)))) for i in range(150)]
    assert rows_of(X.deduplicate(docs_of(rows), primes=(2, 3))) == brute(rows)


def test_empty_table(docs_of):
    assert rows_of(X.deduplicate(docs_of([]))) == []


def test_fingerprints_compose():
    rng = random.Random(2)
    table = X.chunk_table()
    whole = bytes(rng.randrange(256) for _ in range(70_001))

    def fingerprint(body):
        return X.combine(X.chunk_hashes([body], table, X.PRIMES)[0])

    for cut in (0, 1, 16_384, 16_385, 50_000, 70_001):
        assert X.combine([fingerprint(whole[:cut]), fingerprint(whole[cut:])]) == fingerprint(whole)
    # By definition, bytes counted from 1.
    value = 0
    for b in whole[:3000]:
        value = (value * X.BASES[0] + b + 1) % X.PRIMES[0]
    assert fingerprint(whole[:3000])[1] == value


def test_kept_rows_keep_columns(docs_of):
    docs = docs_of(CASES)
    kept = X.kept_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({t for _, _, _, _, t in brute(CASES)})


def test_one_python_worker_a_task(docs_of, monkeypatch):
    docs = docs_of([(1, "a  b"), (2, "a b"), (3, "c"), (4, None), (5, "")])
    chained, fingerprints = [], X.fingerprints

    def seen(*args, **kwargs):
        out = fingerprints(*args, **kwargs)
        chained.append(out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython"))
        return out

    monkeypatch.setattr(X, "fingerprints", seen)
    got = {r["doc_id"]: r["keep_id"] for r in X.deduplicate(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4} and chained == [0, 0]


def test_workers_drop_what_other_operators_keep():
    own, other = {1: 1}, {2: 2}
    common.KEPT.update(own=own, other=other)
    try:
        task = common.lean(lambda batches: (b for b in batches), "own")
        assert list(task(iter([7]))) == [7] and own == {1: 1} and other == {}
    finally:
        del common.KEPT["own"], common.KEPT["other"]
