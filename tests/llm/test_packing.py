"""Packing: ids, dominance and plans against brute force, whole tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cubewise.llm import packing as K


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b >= items[i]}:
            at = bins.index(room)
            bins[at] -= items[i]
            place(i + 1, bins)
            bins[at] += items[i]
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best[0]


def checked(plan, counts, capacity):
    seen, sequences = Counter(), defaultdict(list)
    for r in plan.runs:
        assert r.first == seen[r.length]
        seen[r.length] += r.count
        for n in range(r.count):
            sequences[r.sequence + n // r.each].append((r.offset + n % r.each * r.length, r.length))
    assert seen == Counter({k: v for k, v in counts.items() if v})
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(plan.sequences))
    return plan.sequences


def test_dominance_never_costs_a_sequence():
    rng = random.Random(3)
    for _ in range(600):
        capacity = rng.choice([10, 20, 50, 100])
        low = rng.choice([1, capacity // 4, capacity // 3])
        items = [rng.randint(max(1, low), capacity) for _ in range(rng.randint(1, 9))]
        plan, counts = K.Plan(capacity), np.bincount(items, minlength=capacity + 1)
        K.fix_dominating(counts, plan)
        rest = np.repeat(np.arange(capacity + 1), counts).tolist()
        assert plan.sequences + optimum(rest, capacity) == optimum(items, capacity)
        checked(K.make_plan(Counter(items), capacity), Counter(items), capacity)


def test_large_counts():
    rng = random.Random(4)
    counts = {n: rng.randrange(10**6) for n in range(1, 2049) if rng.random() < 0.8}
    plan = K.make_plan(counts)
    assert plan.sequences <= 1.02 * math.ceil(sum(k * v for k, v in counts.items()) / 2048)
    assert sum(r.count for r in plan.runs) == sum(counts.values())


ROWS = [(n, "Some Words, here! " * random.Random(n).randint(0, 400)) for n in range(60)] + [
    (100, None), (101, ""), (102, " \n "), (None, "no id"), (5, "again"), (5, "again"), (103, "don't <|endoftext|> É́ x" * 900)]


@pytest.mark.parametrize("capacity", [2048, 64])
def test_table(docs_of, capacity):
    rows = K.pack_documents(docs_of(ROWS), capacity).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(K.VOCABULARY))
    expected = []
    for i, t in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            expected.append((i, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(places)]).tolist()]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= capacity
    total = sum(n for p in sequences.values() for _, n in p)
    assert len(sequences) <= math.ceil(total / capacity) + 3


def test_numbers_within_a_hot_length(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 7L, id % 50 + 1) as length", "id as ids_crc32")
    ranks = defaultdict(list)
    for r in K.number_within_length(pieces, 5000).collect():
        ranks[r["length"]].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())


def test_empty_table(docs_of):
    assert K.pack_documents(docs_of([])).collect() == []
