import hashlib
import itertools
import random
import re
import zlib

import pytest

from cubewise.llm import structure_repair as sr

SCHEMA = "conv_id long, turn long, role string, text string, kind string, live_ int, shard int"
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    """The contract's damage, row by row: {conv_id: rows after damage}."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults(rows):
    found, before = [], []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not body else "duplicate" if (role, text) in before
                     else "truncated" if body[-1] not in ".!?" else "")
        before.append((role, text))
    return found


def every_repair(rows):
    """All edit sequences with up to three insertions in a row, as (cost, audit, lines)."""
    found = faults(rows)
    gaps = [g for n in range(4) for g in itertools.product("ua", repeat=n)]

    def choices(n):
        _, role, text = rows[n]
        yield "D", 2, None
        if found[n] not in ("blank", "duplicate"):
            extra = 5 if found[n] == "truncated" else 0
            yield "K", extra, (role[:1], f"{role}:{text}")
            for r in "ua":
                yield "R", 1 + extra, (r, f"{ROLE[r]}:{text}")

    def legal_start(initials):
        return re.fullmatch(r"s?(ua)*u?", initials) is not None

    done = []

    def go(n, cost, audit, lines, initials):
        if not legal_start(initials) or cost > 40:
            return
        for gap in gaps:
            more = initials + "".join(gap)
            if not legal_start(more):
                continue
            now = (cost + 5 * len(gap), audit + "I" * len(gap), lines + [f"{ROLE[g]}:" for g in gap], more)
            if n == len(rows):
                if re.fullmatch(r"(s?(ua)+)?", more):
                    done.append(now[:3])
                continue
            for letter, c, line in choices(n):
                if line is None:
                    go(n + 1, now[0] + c, now[1] + letter, now[2], more)
                elif line[0]:
                    go(n + 1, now[0] + c, now[1] + letter, now[2] + [line[1]], more + line[0])

    go(0, 0, "", [], "")
    return min(done, key=lambda d: d[:2])


def expected(rows):
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs)}


def random_rows(rng, n, roles=("user", "assistant", "system", "tool", "", "sys", "user", "assistant")):
    texts = ["Yes.", "no", "", " \n", "why?", "Yes. \t", "é!", "so"]
    return [(rng.choice([None, rng.randint(0, 9)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_repairs_are_the_cheapest_of_all():
    rng = random.Random(3)
    for n in [0, 1, 1, 1, *[2] * 30, *[3] * 60, *[4] * 25]:
        rows = random_rows(rng, n)
        cost, audit, lines = every_repair(rows)
        got = sr.repair([{"turn": t, "role": r, "text": x} for t, r, x in rows])
        want = {**expected(rows), "cost": cost, "audit": audit,
                "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
        assert got == want, rows


def test_long_audits_equal_those_without_setting_prefixes_aside():
    rng = random.Random(5)
    tokens = [(rng.choice("sua t"), rng.random() < 0.1, rng.random() < 0.2) for _ in range(1500)]
    plain = {sr.START: (0, "")}
    for t in tokens:
        plain = sr.read(plain, t)
    assert sr.parse(tokens, {sr.START: (0, "")}) == plain


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(partitions)


def by_hand(rows):
    out = {}
    for conv, kept in damage(rows).items():
        out[conv] = sr.repair([{"turn": t, "role": r, "text": x} for t, r, x in kept])
        assert {k: out[conv][k] for k in expected(kept)} == expected(kept)
    return out


def run(spark, rows):
    got = sr.repair_conversations(sr.damaged(table(spark, rows))).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in got}


@pytest.fixture
def many_shards(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_conversations_over_many_shards(spark, docs_of, many_shards):
    rng = random.Random(11)
    roles, texts = ["user", "assistant", "system", None], ["Sure.", "no", None, "a b?", "\t", "Größe!", "x" * 3000]
    rows = [(c, n if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"t{n} {rng.random()}.")
            for c in [*range(12), None] for n in range(rng.randint(1, 8))]
    hot = [(77, n // 2, rng.choice(roles[:2]), f"turn {rng.randint(0, 150)}{rng.choice('. ')}") for n in range(400)]
    rows += hot + rows[:10]
    assert run(spark, rows) == by_hand(rows)


def test_one_row_repeated_without_end_and_all_dropped(spark, docs_of, many_shards):
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    rows = [(5, 3, "user", "Hi.")] * 300 + [(dropped, 0, "user", "gone.")] + [(6, None, "assistant", "Yes.")]
    got = run(spark, rows)
    assert got == by_hand(rows)
    assert got[dropped]["audit"] == "" and got[dropped]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark, docs_of):
    assert run(spark, []) == {}
