"""SimHash near-duplicates against comparing all pairs in Python."""

import random

import numpy as np
import xxhash

from cubewise.llm import simhash as S


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def check(df, rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    smallest = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    expected = sorted(((i, f"{f:016x}", smallest.get(r)) for (i, _), f, r in zip(rows, fps, roots)), key=str)
    assert sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str) == expected


def test_against_all_pairs(docs_of):
    rng = random.Random(4)
    words = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(300)] for _ in range(4)]
    rows = [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (None, "one"),
            (None, "nobody else says this"), (1006, "x " * 5000), (1006, "x " * 5000), (1007, "a\xa0b c d")]
    for i in range(120):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((2000 - i, rng.choice([" ", "\n"]).join(text)))
    check(S.report(docs_of(rows)), rows)


def test_links_of_a_large_bucket_give_the_same_components(spark, docs_of):
    # Thousands of neighbours in one bucket, cut into parts.
    rng = random.Random(5)
    fps = list({rng.getrandbits(2) << rng.randrange(62) ^ rng.getrandbits(1) << rng.randrange(64) for _ in range(500)}
               | {rng.getrandbits(64) for _ in range(300)})
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = S.links(spark.createDataFrame(signed, "fp long"), block_rows=64).collect()
    at = {f: i for i, f in enumerate(fps)}
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in found:
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert bin(a ^ b).count("1") <= 2
        x, y = root(at[a]), root(at[b])
        parent[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(fps))] == brute_components(fps)


def test_bit_sliced_distances():
    rng = random.Random(6)
    fps = np.array([rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)
                    for _ in range(200)], np.uint64)
    planes, order = S.bit_planes(fps), np.arange(64)
    for radius in range(0, 12):
        for fp in fps[:20].tolist():
            words = S.within_radius(fp, planes, order, radius)
            got = np.unpackbits(words.view(np.uint8), bitorder="little")[:len(fps)]
            assert got.tolist() == [int(bin(fp ^ f).count("1") <= radius) for f in fps.tolist()]


def test_empty_table(docs_of):
    assert S.report(docs_of([])).collect() == []


def test_representatives(docs_of):
    rows = [(3, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (7, "other words here now"), (None, "a b c d e"),
            (None, "no id"), (None, "no id"), (None, "no id either")]
    docs = docs_of(rows)
    out = S.representatives(docs)
    assert out.columns == docs.columns
    assert sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=str) == sorted(
        [(2, rows[1][1]), (7, rows[3][1]), (None, "no id"), (None, "no id either")], key=str)
