"""Suffix-array de-duplication on bytes.

Every 100 bytes of a document are a window. A window is repeated if its bytes
also start earlier: in a document with a smaller id, or in the same document
before. Each byte that a repeated window covers is removed; windows are judged on
the input, not on what is left.

The windows that can be repeated meet by their anchor (see ``repeats``), as the
stretch of text that holds them. A bucket keeps one copy of equal stretches. Of the
stretches of an anchor that differ, the windows whose rolling hash no other window
has are settled: equal windows have equal hashes. What is left of the stretches is
a collection of strings, compared byte for byte: they are dealt to shards, and
each shard has its Burrows-Wheeler transform from its own suffix array. The
shards' transforms are merged by refining their interleave: from the order of all
suffixes by their first h symbols, one pass over the transforms gives the order
by h + step symbols, and with it where the common prefix of neighbours is shorter.
After the passes for 100 symbols, suffixes between two such borders share 100
bytes: the repeated intervals, without sorting the suffixes of different shards
against one another. A step takes several symbols at once through the composed
last-to-first mapping. A suffix that stands alone in its interval leaves the
interleave: so do then all longer ones that end in it.

Defined cases: a null text has no bytes; a text of fewer than 100 bytes loses
none; matches never cross documents (strings end with a symbol of their own);
rows with one id count as one document, compared by place; rows without an id
rank after all others, as one document; an empty table gives no rows; other
columns are dropped. A removal may cut a character; the kept bytes are bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cubewise.llm.byte_bpe import lists, small_batches
from cubewise.llm.repeats import (
    DOC,
    RUN,
    answer,
    chunks,
    covered,
    documents_of,
    keyed,
    messages,
    repeat,
    repeated_windows,
    settled_message,
    stretches,
)
from cubewise.llm.rolling import window_hashes
from cubewise.llm.substring_dedup import BYTE_VALUES

LENGTH = 100
GRAM = 16
#: Symbols that one refinement takes at once, shards of a merge, and the bytes
#: of a merge (whole anchors only, so one anchor's stretches may exceed it).
STEP = 5
SHARDS = 4
MERGE_BYTES = 48_000
#: Bytes whose window hashes are compared together (whole anchors only).
HASHED_BYTES = 1 << 20


def squeeze(whole: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(whole, asbytes=True)


def unsqueeze(body: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(body, size, asbytes=True)


class Bytes:
    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length = length
        self.gram = gram

    def values(self, text: str) -> np.ndarray:
        return BYTE_VALUES[np.frombuffer(text.encode("utf-8"), np.uint8)]


class Shard:
    """The Burrows-Wheeler transform of some strings, each ended by symbol 0."""

    def __init__(self, strings: list[bytes]):
        joined = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.int64) + 1
        joined[np.cumsum([len(s) + 1 for s in strings]) - 1] = 0
        self.rank = suffix_ranks(joined)
        place = np.empty(len(joined), np.int64)
        place[self.rank] = np.arange(len(joined))
        self.transform = joined[place - 1]

    def mapping(self) -> np.ndarray:
        """Last-to-first: the row of the suffix that is one symbol longer."""
        out = np.empty(len(self.transform), np.int64)
        out[np.argsort(self.transform.astype(np.uint16), kind="stable")] = np.arange(len(out))
        return out


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """Rank of each suffix, by doubling the sorted prefix from 7 symbols on. A rank
    is the number of suffixes below, so those that stand alone keep theirs, and only
    the others are sorted again."""
    size = len(symbols)
    padded = np.concatenate((symbols, np.zeros(7, np.int64)))
    key = np.zeros(size, np.int64)
    for j in range(7):
        key = (key << 9) | padded[j:j + size]
    order = np.argsort(key)
    rank = np.empty(size, np.int64)
    rank[order], shared = heads(key[order])
    order, depth = order[shared], 7
    while len(order):
        old = rank[order]
        after = np.zeros(len(order), np.int64)
        inside = np.flatnonzero(order < size - depth)
        after[inside] = rank[order[inside] + depth] + 1
        key = old * (size + 1) + after
        sort = np.argsort(key)
        order, old = order[sort], old[sort]
        head, shared = heads(key[sort])
        rank[order] = old + head - heads(old)[0]
        order = order[shared]
        depth *= 2
    return rank


def heads(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of sorted keys the place of the first that is equal, and whether
    there are several."""
    new = np.ones(len(sorted_keys) + 1, bool)
    new[1:-1] = sorted_keys[1:] != sorted_keys[:-1]
    begin = np.flatnonzero(new)
    return np.repeat(begin[:-1], np.diff(begin)), ~(new[:-1] & new[1:])


def refine(shards: list[Shard], length: int, step: int = STEP) -> list[np.ndarray]:
    """For each shard the interval of each row: rows of equal number have their
    first ``length`` symbols in common (where no string ends before)."""
    sizes = [len(s.transform) for s in shards]
    begin = np.cumsum([0, *sizes])
    transform = np.concatenate([s.transform for s in shards])
    mapping = np.concatenate([s.mapping() + b for s, b in zip(shards, begin, strict=False)])
    interleave = np.arange(begin[-1])
    interval = np.zeros(begin[-1], np.int64)
    rounds = [step] * (length // step) + [1] * (length % step)
    before = 0
    for n in rounds:
        if n != before:
            context, to = np.zeros(len(transform), np.int64), np.arange(len(transform))
            for j in range(n):
                context += transform[to] << (9 * j)
                to = mapping[to]
            context = np.unique(context, return_inverse=True)[1]
            context = context.astype(np.uint16 if context.max() < 1 << 16 else np.uint32)
            before = n
        symbol = context[interleave]
        order = np.argsort(symbol, kind="stable")
        symbol, old = symbol[order], interval[order]
        interleave = to[interleave[order]]
        border = np.ones(len(order) + 1, bool)
        border[1:-1] = (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])
        shared = ~(border[:-1] & border[1:])
        interval = np.cumsum(border[:-1])[shared]
        interleave = interleave[shared]
    # Rows that left have numbers of their own, above the intervals'.
    of_row = np.arange(len(transform)) + len(transform) + 1
    of_row[interleave] = interval
    return [of_row[b:b + n] for b, n in zip(begin, sizes, strict=False)]


def equal_windows(strings: list[bytes], windows: np.ndarray, length: int, shards: int = SHARDS) -> np.ndarray:
    """A number for each of the first windows[i] windows of each string, joined;
    equal numbers mean equal bytes."""
    count = min(shards, len(strings))
    edges = [len(strings) * i // count for i in range(count + 1)]
    built = [Shard(strings[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    out = []
    for shard, interval, a, b in zip(built, refine(built, length), edges, edges[1:], strict=False):
        first = np.cumsum([0, *(len(s) + 1 for s in strings[a:b])])[:-1]
        out.append(interval[shard.rank[repeat(first, windows[a:b])]])
    return np.concatenate(out)


def send_stretches(unit: Bytes) -> Callable:
    def with_buckets(buckets: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn = 0
            for rows in chunks(b.select(["k", "th", "text", "runs"]) for b in batches):
                rows.sort(key=lambda r: r[:2])
                k = np.array([r[0] for r in rows], np.int64)
                th = np.array([r[1] for r in rows], np.int64)
                doc, run_list, anchor, body, later = [], [], [], [], []
                seen: dict[bytes, tuple[int, int]] = {}
                for d, (key, _, text, runs) in enumerate(rows):
                    raw = text.encode("utf-8")
                    record = np.sort(np.frombuffer(runs, RUN), order="first")
                    first = record["first"].astype(np.int64)
                    grams = window_hashes(BYTE_VALUES[np.frombuffer(raw, np.uint8)], unit.gram)
                    for at in range(0, len(first), 4096):
                        inside = first[at:at + 4096, None] + np.arange(unit.length - unit.gram + 1)
                        anchor.append((grams[inside] >> np.uint64(32)).min(axis=1))
                    for a, n in zip(first.tolist(), record["n"].tolist(), strict=True):
                        piece = raw[a:a + n + unit.length - 1]
                        # Of equal stretches the earliest goes out; rows come by id.
                        later.append(seen.setdefault(piece, (key, a)) != (key, a))
                        body.append(piece)
                    doc.append(np.full(len(first), d))
                    run_list.append(record)
                doc, run_list, anchor = np.concatenate(doc), np.concatenate(run_list), np.concatenate(anchor)
                later = np.array(later, bool)
                out = list(settled_message(turn % buckets, k, th, doc[later], run_list[later]))
                turn += 1
                send = np.flatnonzero(~later)
                to = (anchor[send] % np.uint64(buckets)).astype(np.int64)
                send = send[np.argsort(to, kind="stable")]
                edges = np.searchsorted(np.sort(to), np.arange(buckets + 1))
                for b in range(buckets):
                    part = send[edges[b]:edges[b + 1]]
                    if len(part):
                        whole = b"".join([body[i] for i in part.tolist()])
                        out.append((b, False, documents_of(k, th, doc[part]).tobytes(), run_list[part].tobytes(),
                                    anchor[part].astype("<u4").tobytes(), len(whole).to_bytes(8, "little"),
                                    squeeze(whole)))
                yield messages(out)

        return run

    return with_buckets


def settle_stretches(unit: Bytes) -> Callable:
    """Answer which windows start earlier."""
    def run(dests: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, held, number, texts, anchor_of = [], [], {}, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs, runs = np.frombuffer(row[2], DOC), np.frombuffer(row[3], RUN)
                if row[1]:
                    given.append((docs, runs))
                    continue
                whole = unsqueeze(row[6], int.from_bytes(row[5], "little"))
                anchors = np.frombuffer(row[4], "<u4")
                ends = np.cumsum(runs["n"].astype(np.int64) + unit.length - 1).tolist()
                which, at = np.empty(len(runs), np.int64), 0
                for i, (end, a) in enumerate(zip(ends, anchors.tolist(), strict=True)):
                    piece = whole[at:end]
                    at = end
                    v = which[i] = number.setdefault(piece, len(texts))
                    if v == len(texts):
                        texts.append(piece)
                        anchor_of.append(a)
                held.append((docs, runs, which))
        if not held:
            yield answer(given, dests)
            return
        number.clear()
        windows = np.array([len(t) for t in texts], np.int64) - unit.length + 1
        begin = np.cumsum(windows) - windows
        k = np.concatenate([np.repeat(d["k"], d["runs"]) for d, _, _ in held])
        first = np.concatenate([r["first"] for _, r, _ in held]).astype(np.int64)
        which = np.concatenate([w for _, _, w in held])
        # Each stretch's earliest occurrence gives its windows' earliest.
        earliest = np.lexsort((first, k, which))
        earliest = earliest[np.concatenate(([True], which[earliest][1:] != which[earliest][:-1]))]
        least_k = np.repeat(k[earliest], windows)
        least_at = repeat(first[earliest], windows)
        anchor_of = np.array(anchor_of, np.int64)
        for group, strings, at, n in shared_stretches(anchor_of, texts, windows, unit.length):
            spot = repeat(begin[group] + at, n)
            same = equal_windows(strings, n, unit.length)
            order = np.lexsort((least_at[spot], least_k[spot], same))
            head = np.concatenate(([True], same[order][1:] != same[order][:-1]))
            source = spot[order[np.flatnonzero(head)[np.cumsum(head) - 1]]]
            least_k[spot[order]], least_at[spot[order]] = least_k[source], least_at[source]
        for docs, runs, which in held:
            n = runs["n"].astype(np.int64)
            place = repeat(runs["first"].astype(np.int64), n)
            spot = repeat(begin[which], n)
            own = np.repeat(np.repeat(docs["k"], docs["runs"]), n)
            later = (own > least_k[spot]) | ((own == least_k[spot]) & (place > least_at[spot]))
            run_number, found = stretches(later, np.repeat(np.arange(len(runs)), n), place)
            doc = np.repeat(np.arange(len(docs)), docs["runs"])[run_number]
            given.append((documents_of(docs["k"], docs["th"], doc), found))
        yield answer(given, dests)

    return lambda dests: lambda batches: run(dests, batches)


def shared_stretches(anchor: np.ndarray, texts: list[bytes], windows: np.ndarray, length: int) \
        -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """What to compare: for each merge the numbers of the texts, the stretches of
    them whose windows have a hash that occurs again, their first windows and their
    numbers of windows. A window left out equals no other."""
    width = windows + length - 1
    for group in merges(anchor, width, HASHED_BYTES):
        strings = [texts[i] for i in group.tolist()]
        begin = np.cumsum(width[group]) - width[group]
        n = windows[group]
        whole = np.frombuffer(b"".join(strings), np.uint8)
        hashes = window_hashes(BYTE_VALUES[whole], length)[repeat(begin, n)]
        order = np.argsort(hashes)
        again = np.empty(len(hashes), bool)
        again[order] = heads(hashes[order])[1]
        which = np.repeat(np.arange(len(group)), n)
        place = repeat(np.zeros(len(group), np.int64), n)
        of, found = stretches(again, which, place)
        first, count = found["first"].astype(np.int64), found["n"].astype(np.int64)
        for part in merges(anchor[group[of]], count + length - 1, MERGE_BYTES):
            cut = zip(of[part].tolist(), first[part].tolist(), count[part].tolist(), strict=True)
            yield (group[of[part]], [strings[i][a:a + c + length - 1] for i, a, c in cut], first[part], count[part])


def merges(anchor: np.ndarray, width: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Numbers of stretches (of so many bytes) to look at together: whole anchors
    with several stretches, until there are ``most`` bytes."""
    order = np.argsort(anchor, kind="stable")
    order = order[heads(anchor[order])[1]]
    if not len(order):
        return
    first = np.unique(heads(anchor[order])[0])
    size = np.add.reduceat(width[order] + 1, first)
    held, begin = 0, 0
    for a, n in zip(np.append(first[1:], len(order)).tolist(), size.tolist(), strict=True):
        held += n
        if held >= most:
            yield order[begin:a]
            held, begin = 0, a
    if begin < len(order):
        yield order[begin:]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, starts, ends, kept): the removed runs of
    bytes, and the bytes that stay."""
    return _finish(docs, id_col, text_col, Bytes(length, gram), digest=False)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row a document."""
    return _finish(docs, id_col, text_col, Bytes(length, gram), digest=True)


def _finish(docs: DataFrame, id_col: str, text_col: str, unit: Bytes, digest: bool) -> DataFrame:
    fields = f"doc_id {dict(docs.dtypes)[id_col]}, n_bytes bigint, n_removed bigint, "
    fields += "n_spans bigint, kept_sha256 string" if digest else "starts array<bigint>, ends array<bigint>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            total, removed, kept, spans = [], [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                gone = covered(runs, len(raw), unit.length)
                total.append(len(raw))
                removed.append(int(gone.sum()))
                kept.append(raw[~gone].tobytes())
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).astype(np.int64))
            last = ([pa.array([len(s) // 2 for s in spans], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())] if digest else
                    [lists([s[::2] for s in spans], pa.int64()), lists([s[1::2] for s in spans], pa.int64()),
                     pa.array(kept, pa.binary())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), *last],
                names=[f.split()[0] for f in fields.split(", ")])

    found = repeated_windows(keyed(docs, id_col, text_col), unit, send_stretches(unit), settle_stretches(unit))
    return found.select("doc_id", "text", "runs").mapInArrow(run, fields)
