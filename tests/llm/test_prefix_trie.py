import hashlib
import random
import zlib

import numpy as np
import pytest

from cubewise.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, id string, depth int, chars int"


def by_hand(rows):
    """The contract's nodes by dictionaries over whole sequences."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fix(c / 100)) * 100
        paths[c] = tuple(turns.get(base, [])[:h] + ts[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [totals[n] for n in children.get(node, [])]
        totals[node] = (sum(b[0] for b in below) if below else 1, own_saved + sum(b[1] for b in below))
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
                    *totals[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    found = pt.trie(table)
    assert found.columns == pt.NODE_COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


def conversations(rng, convs, most=7, roles=("user", "assistant", None), words=("a", "bb", "", None, "é\U0001f600")):
    return [(c, rng.choice([None, n, n]), rng.choice(roles), rng.choice(words))
            for c in convs for n in range(rng.randint(1, most))]


@pytest.fixture
def shards_of(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("shards", [1, 11])
def test_nodes_equal_those_by_hand(spark, docs_of, shards_of, shards):
    shards_of(shards)
    rng = random.Random(shards)
    ids = [*range(0, 40), *range(98, 106), *range(203, 206), -7, -100, -105]
    rows = conversations(rng, ids) + [(None, 0, "user", "no id")]
    rows += rows[:5]
    assert run(spark, rows) == by_hand(rows)


def test_copies_and_long_conversations(spark, docs_of, shards_of, monkeypatch):
    """A third of the conversations are equal, one is very long, two share many turns."""
    monkeypatch.setattr(pt, "BAND", 4)
    monkeypatch.setattr(pt, "BLOCK", 8)
    monkeypatch.setattr(pt, "CHAIN", 7)
    shards_of(7)
    rng = random.Random(2)
    rows = conversations(rng, range(1, 30), most=5)
    rows += [(c, n, "user", f"same {n}") for c in range(1000, 1090, 2) for n in range(7)]
    rows += [(2001, n, "user", f"turn {n}") for n in range(150)]
    rows += [(c, n, "user", f"shared {n}") for c in (3003, 3104) for n in range(5, 45)]
    rows += [(3104, n, "user", f"more {n}") for n in range(45, 60)] + [(3207, n, "user", f"shared {n}") for n in range(5, 21)]
    assert run(spark, rows) == by_hand(rows)


def test_salted_parents_give_the_same(spark, docs_of, shards_of, monkeypatch):
    monkeypatch.setattr(pt, "SMALL", 0)
    shards_of(5)
    rows = conversations(random.Random(4), range(60), most=3)
    assert run(spark, rows) == by_hand(rows)


def test_ends_in_chunks(spark, docs_of, shards_of, monkeypatch):
    monkeypatch.setattr(pt, "ENDS", 3)
    shards_of(6)
    rows = [(c, 0, "user", "hi") for c in range(40)] + [(7, 1, "user", "x")]
    assert run(spark, rows) == by_hand(rows)


def test_turnless_conversations_and_empty_table(spark, docs_of):
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(lone, 0, "user", "gone")]
    assert run(spark, rows) == by_hand(rows) and len(by_hand(rows)) == 1
    assert run(spark, []) == []
