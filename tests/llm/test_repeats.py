"""Word-window and byte-string de-duplication against brute force."""

import hashlib
import random

import numpy as np

from cubewise.llm import repeats as R
from cubewise.llm import substring_dedup as W
from cubewise.llm import suffix_dedup as B


def key(i):
    return (1 << 63) - 1 if i is None else i


def brute_words(rows, length=50):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, ws in split:
        for a in range(len(ws) - length + 1):
            g = tuple(ws[a:a + length])
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, ws in split:
        gone = set()
        for a in range(len(ws) - length + 1):
            if first[tuple(ws[a:a + length])] < key(i):
                gone.update(range(a, a + length))
        kept = b" ".join(w for n, w in enumerate(ws) if n not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, length=100):
    first = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, r in raws:
        for a in range(len(r) - length + 1):
            g = r[a:a + length]
            first[g] = min(first.get(g, (key(i), a)), (key(i), a))
    out = []
    for i, r in raws:
        gone = np.zeros(len(r), bool)
        for a in range(len(r) - length + 1):
            if first[r[a:a + length]] < (key(i), a):
                gone[a:a + length] = True
        spans = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((i, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.choice([20, 49, 50, 51, 60, 130, 300]))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                p = list(rng.choice(passages))
                if rng.random() < 0.4:
                    p[rng.randrange(len(p))] = rng.choice(words)
                if rng.random() < 0.3:
                    p = p[rng.randrange(len(p)):]
                text += p
            else:
                text += [rng.choice(words) for _ in range(rng.randint(1, 120))]
        rows.append((rng.randrange(10 * n), rng.choice([" ", "\n", "  "]).join(text)))
    rows += [(5, None), (6, ""), (7, "a " * 700), (7, "a " * 700), (8, "a " * 300), (9, "ab" * 400), (10, "x" * 99),
             (11, "x" * 100), (12, "x" * 101), (None, rows[0][1]), (None, rows[0][1]), (None, "q r s " * 60),
             (13, rows[1][1]), (13, rows[1][1]), (13, rows[2][1]), (14, "z" * 5000 + " " + "y " * 90)]
    return rows


def test_words(docs_of):
    for seed in (1, 2):
        rows = corpus(seed)
        got = W.report(docs_of(rows)).collect()
        assert sorted(map(tuple, got), key=str) == brute_words(rows)


def test_bytes(docs_of):
    for seed in (3, 4):
        rows = corpus(seed)
        got = B.report(docs_of(rows)).collect()
        assert sorted(map(tuple, got), key=str) == brute_bytes(rows)


def test_intervals_are_maximal(docs_of):
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text), (2, "new " + text + " end"), (3, " ".join(f"w{i}" for i in range(60)))]
    got = {r["doc_id"]: r for r in W.remove_repeats(docs_of(rows)).collect()}
    assert (got[1]["starts"], got[1]["kept"]) == ([], text)
    assert (got[2]["starts"], got[2]["ends"], got[2]["kept"]) == ([1], [121], "new end")
    assert (got[3]["starts"], got[3]["ends"], got[3]["kept"]) == ([0], [60], "")
    got = {r["doc_id"]: r for r in B.remove_repeats(docs_of(rows)).collect()}
    assert bytes(got[2]["kept"]) == b"new  end" or bytes(got[2]["kept"]) == b"new " + b" end"


def test_copies_of_more_words_than_a_run_counts(docs_of):
    # Five equal texts in four partitions: some task holds several of them.
    words = 2 * R.MOST_WINDOWS + 1000
    text = " ".join(f"w{i % 9973}x{i // 9973}" for i in range(words))
    got = {r["doc_id"]: r for r in W.report(docs_of([(i, text) for i in range(5)])).collect()}
    assert [got[i]["n_removed"] for i in range(5)] == [0] + [words] * 4


def test_long_stretches_are_cut_into_records():
    for n in (R.MOST_WINDOWS, R.MOST_WINDOWS + 1, 3 * R.MOST_WINDOWS + 7):
        flags = np.ones(n + 5, bool)
        flags[3] = False
        run, records = R.stretches(flags, np.zeros(n + 5, np.int64), np.arange(n + 5))
        assert len(run) == len(records) and records["n"].astype(int).sum() == n + 4
        gone = R.covered(records.tobytes(), n + 5, 1)
        assert (gone == flags).all()


def test_empty_table(docs_of):
    assert W.report(docs_of([])).collect() == []
    assert B.report(docs_of([])).collect() == []


def test_merged_transforms_find_equal_windows():
    rng = random.Random(7)
    for _ in range(60):
        length = rng.choice([3, 5, 7, 11])
        strings = [bytes(rng.choice(b"ab\x00\xff") for _ in range(length + rng.randrange(12)))
                   for _ in range(rng.randint(1, 9))]
        windows = np.array([len(s) - length + 1 for s in strings])
        same = B.equal_windows(strings, windows, length, shards=rng.randint(1, 4))
        text = [s[a:a + length] for s in strings for a in range(len(s) - length + 1)]
        assert len(same) == len(text)
        assert len(set(zip(same.tolist(), text))) == len(set(text)) == len(set(same.tolist()))


def test_shard_is_a_transform():
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30))) for _ in range(5)]
    joined = [x for s in strings for x in [*(b + 1 for b in s), 0]]
    order = sorted(range(len(joined)), key=lambda i: joined[i:])
    shard = B.Shard(strings)
    assert [int(shard.rank[i]) for i in order] == list(range(len(joined)))
    assert shard.transform.tolist() == [joined[i - 1] for i in order]


def test_only_windows_that_may_be_equal_are_merged():
    # All stretches of an anchor share its gram; one passage is longer than a window.
    rng = random.Random(9)
    word = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    gram, passage = word(20), word(130)
    texts = [word(90) + gram + word(90) for _ in range(40)] + [word(50) + gram + passage + word(50) for _ in range(2)]
    windows = np.array([len(t) - 99 for t in texts])
    merged = list(B.shared_stretches(np.zeros(len(texts), np.int64), texts, windows, 100))
    assert [g.tolist() for g, *_ in merged] == [[40, 41]]
    _, strings, first, n = merged[0]
    assert strings == [gram + passage] * 2 and first.tolist() == [50, 50] and n.tolist() == [51, 51]


def test_ranks_of_suffixes_that_share_much():
    rng = random.Random(10)
    for _ in range(40):
        part = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
        symbols = [*(part * rng.randint(1, 4)), *[rng.randint(1, 3) for _ in range(rng.randint(0, 9))], 0]
        order = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert np.argsort(B.suffix_ranks(np.array(symbols))).tolist() == order
