"""Winnowing against its definition, and the neighbours against a plain loop."""

import hashlib
import random

import numpy as np
import pytest

from cubewise.llm import winnowing as N
from cubewise.llm.rolling import anchors, rightmost_minima, window_hashes


def test_rightmost_minima_by_definition():
    rng = random.Random(1)
    for _ in range(50):
        h = np.array([rng.randrange(4) << 40 for _ in range(rng.randint(1, 60))], np.uint64)
        w = rng.randint(1, 12)
        expected = [max(range(a, a + w), key=lambda i: (-int(h[i]), i)) for a in range(len(h) - w + 1)]
        assert rightmost_minima(h, w).tolist() == expected
        at, first, n = anchors(h, w)
        assert np.repeat(at, n).tolist() == expected
        assert first.tolist() == (np.cumsum(n) - n).tolist()


def test_window_hashes_over_blocks():
    values = np.arange(100_000, dtype=np.uint64) % np.uint64(977)
    h = window_hashes(values, 12)
    assert len(h) == 100_000 - 11
    assert (h[:977 * 80] == np.tile(h[:977], 80)).all()


def test_common_passages_share_a_hash():
    rng = random.Random(2)
    for _ in range(100):
        common = "".join(rng.choice("abcdefgh é😀") for _ in range(N.WINDOW + N.GRAM - 1))
        a = "".join(rng.choice("ijk") for _ in range(rng.randint(0, 40))) + common
        b = "".join(rng.choice("lmn") for _ in range(rng.randint(0, 40))) + common + "opq"
        x, y = N.winnow(a), N.winnow(b)
        assert set(x.hashes.tolist()) & set(y.hashes.tolist())


ROWS = [(i * 3, "".join(random.Random(i).choice("abc defé\n") for _ in range(n)))
        for i, n in enumerate([0, 1, 2, 3, 5, 11, 12, 13, 20, 21, 100, 333, 1000, 5000, 80_000, 40, 41, 42])]


def expected(rows):
    line = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (d, t) in enumerate(line):
        t, following = t or "", line[(i + 1) % len(line)][1] or ""
        third = len(t) // 3
        edited = t[:len(t) - third] + following[:third]
        own, other = N.winnow(t), N.winnow(edited)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), own.digest(), other.digest(),
                    pytest.approx(N.likeness(own, other)), pytest.approx(N.likeness(own, N.winnow(following)))))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("rows", [ROWS, [*ROWS, (7, None), (10_000, None)], [(5, "alone in the table")], ROWS[:2]])
def test_neighbours(docs_of, rows):
    got = sorted(map(tuple, N.compare_neighbours(docs_of(rows)).collect()), key=lambda r: r[0])
    assert got == expected(rows)


def test_ties_and_rows_without_id(docs_of):
    rows = [(1, "same"), (1, "same"), (1, "other text"), (None, "x"), (None, "x"), (2, "end")]
    got = N.compare_neighbours(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in got) == [(-1, 1), (-1, 1), (1, 4), (1, 4), (1, 10), (2, 3)]
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 4}) == 1


def test_empty_table_and_fingerprints(docs_of):
    assert N.compare_neighbours(docs_of([])).collect() == []
    row = N.fingerprints(docs_of([(1, ROWS[12][1])])).first()
    own = N.winnow(ROWS[12][1])
    assert row["positions"] == own.positions.tolist()
    assert [h % (1 << 64) for h in row["hashes"]] == own.hashes.tolist()
