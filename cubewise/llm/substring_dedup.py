"""Substring de-duplication on word windows.

Every 50 consecutive words of a document have a Rabin-Karp hash. A window is
repeated if its words also start in a document with a smaller id; each word that
a repeated window covers is removed. Overlapping repeated windows merge into
maximal removal intervals. Windows are judged on the input, not on what is left.

Hashes are counted in buckets (see ``repeats``): a window is sent only if its
anchor, a gram of ten words inside it, occurs elsewhere; a bucket finds for each
hash the smallest document, and every other document's window is repeated. Equal
windows have equal anchors, so hash and anchor are compared, 96 bits together.

Defined cases: a null text has no words; a document of fewer than 50 words loses
none; rows with the same id never remove one another's words; rows without an id
rank after all others and never remove one another's words either; an empty table
gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
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
from cubewise.llm.rolling import mix, span_hashes, window_hashes

LENGTH = 50
GRAM = 10
# Longer words get a hash of their own: a polynomial modulo 2**64 is weak on
# very long structured input.
LONG_WORD = 256

BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length = length
        self.gram = gram

    def values(self, text: str) -> np.ndarray:
        """A hash of each word."""
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        if not len(raw):
            return np.empty(0, np.uint64)
        word = np.zeros(len(raw) + 2, np.int8)
        word[1:-1] = ~_SPACE[raw]
        edge = np.diff(word)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out = span_hashes(BYTE_VALUES[raw], starts, ends)
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            out[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]].tobytes())
        return out


def send_windows(unit: Words) -> Callable:
    def with_buckets(buckets: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn = 0
            for rows in chunks(b.select(["k", "th", "text", "runs"]) for b in batches):
                rows.sort(key=lambda r: r[:2])
                k = np.array([r[0] for r in rows], np.int64)
                th = np.array([r[1] for r in rows], np.int64)
                doc, place, anchor, window, run_of, runs_seen = [], [], [], [], [], 0
                for d, (_, _, text, runs) in enumerate(rows):
                    values = unit.values(text)
                    record = np.sort(np.frombuffer(runs, RUN), order="first")
                    n = record["n"].astype(np.int64)
                    at = repeat(record["first"].astype(np.int64), n)
                    window.append(window_hashes(values, unit.length)[at])
                    grams = window_hashes(values, unit.gram)
                    # The anchor of a run is the smallest gram of its first window.
                    inside = record["first"].astype(np.int64)[:, None] + np.arange(unit.length - unit.gram + 1)
                    anchor.append(np.repeat((grams[inside] >> np.uint64(32)).min(axis=1), n))
                    place.append(at)
                    doc.append(np.full(len(at), d))
                    run_of.append(np.repeat(np.arange(len(n)) + runs_seen, n))
                    runs_seen += len(n)
                doc, place, run_of = np.concatenate(doc), np.concatenate(place), np.concatenate(run_of)
                anchor, window = np.concatenate(anchor), np.concatenate(window)
                smallest = smallest_id(window, anchor, k[doc])
                later = k[doc] > smallest
                number, runs = stretches(later, doc, place)
                out = list(settled_message(turn % buckets, k, th, number, runs))
                turn += 1
                # Of each window the first document's goes out.
                left = np.flatnonzero(~later)
                _, runs = stretches(~later, run_of, place)
                ends = np.cumsum(runs["n"], dtype=np.int64)
                head = left[ends - runs["n"]]
                sender, to = doc[head], (anchor[head] % np.uint64(buckets)).astype(np.int64)
                # Windows of the stretches, in their order; the stretches by bucket.
                by_bucket = np.argsort(to, kind="stable")
                edges = np.searchsorted(to[by_bucket], np.arange(buckets + 1))
                for b in range(buckets):
                    part = by_bucket[edges[b]:edges[b + 1]]
                    if len(part):
                        n = runs["n"][part].astype(np.int64)
                        taken = left[repeat(ends[part] - n, n)]
                        out.append((b, False, documents_of(k, th, sender[part]).tobytes(), runs[part].tobytes(),
                                    window[taken].tobytes(), anchor[head[part]].astype("<u4").tobytes(), b""))
                yield messages(out)

        return run

    return with_buckets


def smallest_id(window: np.ndarray, anchor: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The smallest id among the windows equal to each (hash and anchor)."""
    out = np.empty(len(window), np.int64)
    if not len(window):
        return out
    order = np.argsort(window)
    w, a = window[order], anchor[order]
    if ((w[1:] == w[:-1]) & (a[1:] != a[:-1])).any():
        order = np.lexsort((anchor, window))
        w, a = window[order], anchor[order]
    begin = np.concatenate(([0], np.flatnonzero((w[1:] != w[:-1]) | (a[1:] != a[:-1])) + 1))
    size = np.diff(np.append(begin, len(w)))
    out[order] = np.repeat(np.minimum.reduceat(k[order], begin), size)
    return out


def settle_windows(dests: int) -> Callable:
    """Answer which windows start in a document with a smaller id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, held = [], []
        for batch in batches:
            for _, settled, docs, runs, window, anchor, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs, runs = np.frombuffer(docs, DOC), np.frombuffer(runs, RUN)
                if settled:
                    given.append((docs, runs))
                else:
                    held.append((docs, runs, np.frombuffer(window, np.uint64), np.frombuffer(anchor, "<u4")))
        if held:
            k = [np.repeat(np.repeat(d["k"], d["runs"]), r["n"]) for d, r, _, _ in held]
            smallest = smallest_id(np.concatenate([w for _, _, w, _ in held]),
                                   np.concatenate([np.repeat(a, r["n"]) for _, r, _, a in held]), np.concatenate(k))
            at = 0
            for (docs, runs, window, _), ids in zip(held, k, strict=True):
                later = ids > smallest[at:at + len(window)]
                at += len(window)
                n = runs["n"].astype(np.int64)
                number, found = stretches(later, np.repeat(np.arange(len(runs)), n), repeat(runs["first"].astype(np.int64), n))
                doc = np.repeat(np.arange(len(docs)), docs["runs"])[number]
                given.append((documents_of(docs["k"], docs["th"], doc), found))
        yield answer(given, dests)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, starts, ends, kept): the removed intervals in
    words, and the kept words joined by one space."""
    return _finish(docs, id_col, text_col, Words(length, gram), digest=False)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row a document."""
    return _finish(docs, id_col, text_col, Words(length, gram), digest=True)


def _finish(docs: DataFrame, id_col: str, text_col: str, unit: Words, digest: bool) -> DataFrame:
    fields = f"doc_id {dict(docs.dtypes)[id_col]}, n_words bigint, n_removed bigint, "
    fields += "kept_sha256 string" if digest else "starts array<bigint>, ends array<bigint>, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            total, removed, kept, spans = [], [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                words = text.encode("utf-8").split()
                gone = covered(runs, len(words), unit.length)
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).astype(np.int64))
            last = ([pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())] if digest else
                    [lists([s[::2] for s in spans], pa.int64()), lists([s[1::2] for s in spans], pa.int64()),
                     pa.array([x.decode("utf-8") for x in kept], pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), *last],
                names=[f.split()[0] for f in fields.split(", ")])

    found = repeated_windows(keyed(docs, id_col, text_col), unit, send_windows(unit), settle_windows)
    return found.select("doc_id", "text", "runs").mapInArrow(run, fields)
