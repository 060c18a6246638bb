"""Conversation structure repair: a generalised LR parse with edits.

A repaired conversation's role initials are ``(s?(ua)+)?``, by the grammar

    C -> P | (empty)      P -> H u a | P u a      H -> s | (empty)

``ACTION`` and ``GOTO`` are its LR table. The parser reads a conversation's rows and
follows every edit at once: keep a row, re-role it to user or assistant, delete
it, insert an empty user or assistant turn anywhere. Parse stacks are linked
nodes (state, node below) that share their tails, a graph-structured stack;
wherever two edit sequences reach equal stack tops, the smaller (cost, audit)
stays, the audit being the string of the edits' initials. Audits that reach the
same node after the same rows are never prefixes of each other (what one has
more are insertions, which cost), so the smaller prefix stays the smaller whole.

Rows lie in range shards (``shards``). A conversation inside one shard is repaired
there. One that crosses shards is repaired piece by piece: a piece is parsed
from every stack top with which it may begin, the pieces' answers combine like
matrices over (minimum, join) into the best whole, each piece is written by its
part of the audit, and the written pieces stream through one SHA-256 in order
(a digest is sequential by nature; only a chunk is held at a time). Earlier equal
rows of such a conversation are found by a grouped minimum over digests.

Defined cases: a null role or text counts as one space, also a null id or turn
inside the key that picks the damage; rows without an id form one conversation;
rows sort by turn (nulls first), equal turns by role and text, so copies are
neighbours; a row with an empty role has no initial and cannot be kept as it is;
an empty table gives no rows; other columns are ignored, so their names cannot
clash. Long texts are never cut. A conversation's audit is one string value (two
billion edits at most), and its five candidates meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cubewise.llm.common import stored
from cubewise.llm.shards import conversations, in_shards, shard_number

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
FULL_STOPS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# LR table: a number shifts to that state, a pair reduces (left side, length).
ACTION: dict[tuple[int, str], int | tuple[str, int]] = {
    (0, "s"): 1, (0, "u"): ("H", 0), (2, "u"): 3, (3, "a"): 4, (5, "u"): 6, (6, "a"): 7,
}
GOTO = {(0, "H"): 2, (0, "P"): 5}
# States whose only action is a reduction: it is made at once.
REDUCE = {1: ("H", 1), 4: ("P", 3), 7: ("P", 3)}
ACCEPTING = {0, 5}

# A node of the stack graph: (state, node below).
Node = tuple
Frontier = dict[Node, tuple[int, str]]
START: Node = (0, None)


@cache
def move(node: Node, symbol: str) -> Node | None:
    """The stack after reading a symbol; None if the grammar does not allow it."""
    while True:
        action = ACTION.get((node[0], symbol))
        if action is None:
            return None
        if isinstance(action, tuple):
            node = reduced(node, action)
            continue
        node = (action, node)
        while node[0] in REDUCE:
            node = reduced(node, REDUCE[node[0]])
        return node


def reduced(node: Node, rule: tuple[str, int]) -> Node:
    left, length = rule
    for _ in range(length):
        node = node[1]
    return (GOTO[node[0], left], node)


def every_node() -> list[Node]:
    """The stacks that any conversation can reach, in a fixed order."""
    found = [START]
    for node in found:
        found += [n for s in "sua" if (n := move(node, s)) and n not in found]
    return found


NODES = every_node()
Token = tuple[str, bool, bool]  # role initial, must go, truncated


def offer(frontier: Frontier, node: Node | None, cost: int, audit: str) -> bool:
    """Merge an edit sequence into the frontier; True if it is the best at its top."""
    if node is None or node in frontier and frontier[node] <= (cost, audit):
        return False
    frontier[node] = (cost, audit)
    return True


def with_insertions(frontier: Frontier) -> Frontier:
    out, fresh = dict(frontier), list(frontier)
    while fresh:
        node = fresh.pop()
        cost, audit = out[node]
        for symbol in ROLES:
            if offer(out, nxt := move(node, symbol), cost + INSERT, audit + "I"):
                fresh.append(nxt)
    return out


def read(frontier: Frontier, token: Token) -> Frontier:
    initial, must_go, truncated = token
    out: Frontier = {}
    extra = TRUNCATED if truncated else 0
    for node, (cost, audit) in with_insertions(frontier).items():
        offer(out, node, cost + DELETE, audit + "D")
        if must_go:
            continue
        if initial in "sua" and initial:
            offer(out, move(node, initial), cost + extra, audit + "K")
        for symbol in ROLES:
            if symbol != initial:
                offer(out, move(node, symbol), cost + REROLE + extra, audit + "R")
    return out


def parse(tokens: list[Token], frontier: Frontier) -> Frontier:
    """The frontier behind the tokens. What all audits begin with is set aside
    now and then, so that long conversations do not copy it at every row."""
    aside = []
    for n, token in enumerate(tokens, 1):
        frontier = read(frontier, token)
        if n % 256 == 0:
            common = commonprefix([audit for _, audit in frontier.values()])
            aside.append(common)
            frontier = {node: (cost, audit[len(common):]) for node, (cost, audit) in frontier.items()}
    start = "".join(aside)
    return {node: (cost, start + audit) for node, (cost, audit) in frontier.items()}


def accepted(frontier: Frontier) -> tuple[int, str]:
    """The cheapest (cost, audit) that ends a conversation, trailing insertions included."""
    return min(best for node, best in with_insertions(frontier).items() if node[0] in ACCEPTING)


def write(rows: list[dict], audit: str, node: Node) -> list[str]:
    """Lines ``role:text`` of rows edited by an audit, from a stack top on."""
    lines, left = [], iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit == "D":
            continue
        symbol = row["role"][0] if edit == "K" else next(s for s in ROLES if move(node, s))
        node = move(node, symbol)
        role = row["role"] if edit == "K" else ROLES[symbol]
        lines.append(f"{role}:{row['text'] if row else ''}")
    return lines


def fault(text: str, seen: bool) -> str:
    body = text.rstrip(BLANKS)
    return "blank" if not body else "duplicate" if seen else "truncated" if body[-1] not in FULL_STOPS else ""


COUNTS = ["blank", "duplicate", "truncated"]


def survey(rows: list[dict], seen: list[bool]) -> tuple[dict, list[Token]]:
    """What is counted of rows in order, and their tokens."""
    faults = [fault(r["text"], s) for r, s in zip(rows, seen, strict=True)]
    initials = [r["role"][:1] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    counts = {c: faults.count(c) for c in COUNTS} | {
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "n_turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
        "n_rows": len(rows), "first_role": initials[0] if rows else None, "last_role": initials[-1] if rows else None}
    return counts, [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)]


def gaps(counts: dict) -> int:
    return 0 if counts["low"] is None else counts["high"] - counts["low"] + 1 - counts["n_turns"]


def repair(rows: list[dict]) -> dict:
    """The result columns for a whole conversation's rows."""
    known: set[tuple[str, str]] = set()
    seen = []
    for r in rows:
        key = (r["role"], r["text"])
        seen.append(key in known)
        known.add(key)
    counts, tokens = survey(rows, seen)
    cost, audit = accepted(parse(tokens, {START: (0, "")}))
    text = "\n".join(write(rows, audit, START))
    return {"gaps": gaps(counts), **{c: counts[c] for c in [*COUNTS, "illegal"]}, "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live) after the contract's damage; a dropped row
    stays as one that is not live, so that its conversation is known."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce("text", F.lit(" "))
    return (turns.select("conv_id", "turn", kind.alias("kind"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"))
            .select("conv_id", "turn",
                    F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(True), F.lit(True)))
                              .otherwise(F.array(F.col("kind") != 0))).alias("live")))


RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
RESULT_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of rows (conv_id, turn, role, text, live), one row a conversation."""
    id_type = dict(rows.dtypes)["conv_id"]
    turn_type = dict(rows.dtypes)["turn"]
    schema = (f"conv_id {id_type}, whole boolean, {RESULT}, shard int, slot int, seq bigint, "
              f"turn {turn_type}, role string, text string, live boolean")
    names = [c.split()[0] for c in schema.split(", ")]

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, slot, held = shard_number(), [], 0, 0
        for conv, found, whole in conversations(batches):
            if whole:
                out.append({"conv_id": conv, "whole": True, **repair([r for r in found if r["live"]])})
            else:
                out += [{**r, "whole": False, "shard": shard, "slot": slot, "seq": n} for n, r in enumerate(found)]
                slot = 1
            held += sum(len(r["text"]) for r in found)
            if held > 8 << 20:
                yield batch_of(out)
                out, held = [], 0
        if out:
            yield batch_of(out)

    arrow_schema = to_arrow_schema(T.StructType.fromDDL(schema))

    def batch_of(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: [r.get(n) for r in found] for n in names}, schema=arrow_schema)

    done = stored(in_shards(rows, ["conv_id", "turn", "role", "text", "live"], ("role", "text"))
                  .mapInArrow(repaired, schema), "repaired")
    crossing = repair_crossing(done.where("not whole").select("conv_id", "shard", "slot", "seq", "turn", "role", "text", "live"))
    return done.where("whole").select("conv_id", *RESULT_COLUMNS).unionByName(crossing)


def repair_crossing(rows: DataFrame) -> DataFrame:
    """The result for conversations given as pieces (shard, slot) of numbered rows."""
    id_type = dict(rows.dtypes)["conv_id"]
    content = F.sha2(F.encode(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), "UTF-8"), 256)
    firsts = (rows.where("live").groupBy("conv_id", content.alias("content"))
              .agg(F.min(F.struct("shard", "slot", "seq")).alias("at")).select("at.*", F.lit(False).alias("seen")))
    rows = stored(rows.join(firsts, ["shard", "slot", "seq"], "left")
                  .withColumn("seen", F.coalesce("seen", F.lit(True))), "pieces")

    counted = ("n_rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, n_turns bigint, "
               "low bigint, high bigint, first_role string, last_role string")
    paths = "paths array<struct<entry:int,exit:int,cost:bigint,audit:string>>"

    def piece(group: pd.DataFrame) -> pd.DataFrame:
        head = group.iloc[0]
        found = live_rows(group)
        counts, tokens = survey(found, [r["seen"] for r in found])
        ways = [{"entry": NODES.index(entry), "exit": NODES.index(end), "cost": cost, "audit": audit}
                for entry in NODES for end, (cost, audit) in parse(tokens, {entry: (0, "")}).items()]
        return pd.DataFrame([{"conv_id": head["conv_id"], "shard": head["shard"], "slot": head["slot"], **counts, "paths": ways}])

    pieces = rows.groupBy("shard", "slot").applyInPandas(
        piece, f"conv_id {id_type}, shard int, slot int, {counted}, {paths}")

    totals = RESULT.replace(", repaired_sha256 string", "")

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        parts = group.sort_values(["shard", "slot"]).to_dict("records")
        best: dict = {START: (0, [])}
        for part in parts:
            after: dict = {}
            for way in part["paths"]:
                if (came := best.get(NODES[way["entry"]])) is not None:
                    offer(after, NODES[way["exit"]], came[0] + way["cost"], [*came[1], (way["audit"], way["exit"])])
            best = after
        # Every piece's audit ends with a row's edit; insertions at the end join the last.
        cost, steps = min((cost, [*done[:-1], (done[-1][0] + "I" * n, done[-1][1])])
                          for node, (before, done) in best.items() for cost, n in [closing(node, before)])
        entries = [0, *[end for _, end in steps]]
        out = [{"shard": part["shard"], "slot": part["slot"], "entry": entry, "edits": audit}
               for part, entry, (audit, _) in zip(parts, entries, steps)]
        out[0] |= {**total(parts), "cost": cost, "audit": "".join(audit for audit, _ in steps)}
        return pd.DataFrame(out, columns=["shard", "slot", "entry", "edits", *[c.split()[0] for c in totals.split(", ")]])

    chosen = pieces.groupBy("conv_id").applyInPandas(whole, f"shard int, slot int, entry int, edits string, {totals}")

    def written(group: pd.DataFrame, choice: pd.DataFrame) -> pd.DataFrame:
        head, pick = group.iloc[0], choice.iloc[0]
        lines = write(live_rows(group), pick["edits"], NODES[int(pick["entry"])])
        kept = {c: pick[c] for c in choice.columns if c not in ("shard", "slot", "entry", "edits")}
        return pd.DataFrame([{"conv_id": head["conv_id"], "shard": head["shard"], "slot": head["slot"],
                              "chunk": "\n".join(lines), **kept}])

    chunks = rows.groupBy("shard", "slot").cogroup(chosen.groupBy("shard", "slot")).applyInPandas(
        written, f"conv_id {id_type}, shard int, slot int, chunk string, {totals}")

    result_schema = to_arrow_schema(T.StructType.fromDDL(f"conv_id {id_type}, {RESULT}"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, empty = None, hashlib.sha256(), True

        def result() -> pa.RecordBatch:
            row = {"conv_id": held["conv_id"], **{c: held[c] for c in RESULT_COLUMNS[:-1]}, "repaired_sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=result_schema)

        for batch in batches:
            for row in batch.to_pylist():
                if held is None or row["conv_id"] != held["conv_id"]:
                    if held is not None:
                        yield result()
                    held, digest, empty = row, hashlib.sha256(), True
                if row["chunk"]:
                    digest.update(b"" if empty else b"\n")
                    digest.update(row["chunk"].encode())
                    empty = False
        if held is not None:
            yield result()

    return (chunks.repartition("conv_id").sortWithinPartitions("conv_id", "shard", "slot")
            .mapInArrow(hashed, f"conv_id {id_type}, {RESULT}"))


def closing(node: Node, cost: int) -> tuple[int, int]:
    """Cost and number of the insertions that end a conversation at a stack top."""
    if node[0] in ACCEPTING:
        return cost, 0
    return min((total, len(audit)) for end, (total, audit) in with_insertions({node: (cost, "")}).items()
               if end[0] in ACCEPTING)


def live_rows(group: pd.DataFrame) -> list[dict]:
    rows = group.sort_values("seq")
    rows = rows[rows["live"].astype(bool)]
    turns = [None if pd.isna(t) else int(t) for t in rows["turn"]]
    return [{"turn": t, "role": r, "text": x, "seen": bool(s)}
            for t, r, x, s in zip(turns, rows["role"], rows["text"], rows["seen"], strict=True)]


def total(parts: list[dict]) -> dict:
    """Counts of a whole conversation from its pieces in order."""
    live = [p for p in parts if p["n_rows"]]
    known = [p for p in live if not pd.isna(p["low"])]
    out = {c: sum(int(p[c]) for p in live) for c in [*COUNTS, "illegal"]}
    # Neighbouring pieces may share a turn and meet as a pair of roles.
    out["illegal"] += sum(a["last_role"] + b["first_role"] not in LEGAL for a, b in zip(live, live[1:]))
    shared = sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    counts = {"low": int(known[0]["low"]), "high": int(known[-1]["high"]),
              "n_turns": sum(int(p["n_turns"]) for p in known) - shared} if known else {"low": None}
    return {"gaps": gaps(counts), **out}
