"""Repeated windows of a corpus, without moving every window.

A window (50 words, 100 bytes) is repeated if its content also starts earlier in
the corpus. Each window names an anchor: the smallest hash of the short grams in
it, the rightmost on ties. Equal windows have equal anchors at equal places, so

1. every document sends its anchors' hashes (one for some dozens of windows) to
   buckets by hash, and learns which of them occur elsewhere;
2. for those alone it sends the windows, by the same buckets;
3. the buckets settle which windows are repeated and answer the documents.

No window that could be repeated is left out. What a task has already seen
several times it answers itself and sends once, so a passage that a third of all
documents share reaches its bucket once for each task. The documents are dealt
out by their key once; every step reads that one exchange. Answers go by the
key and the hash of the text, so repeated rows are no trouble.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.common import id_order, partitions, text_or_empty
from cubewise.llm.rolling import anchors, mix, window_hashes

#: A run of windows: the first one's place and their number (of more, several records).
RUN = np.dtype([("first", "<u4"), ("n", "<u2")])
MOST_WINDOWS = int(np.iinfo(RUN["n"]).max)
#: A document in a message, with the number of its runs there.
DOC = np.dtype([("k", "<i8"), ("th", "<i8"), ("runs", "<u4")])
#: Text that a task looks at together, to find what repeats within it.
CHUNK_BYTES = 16 << 20

MESSAGE = "bucket int, settled boolean, docs binary, runs binary, hashes binary, known binary, body binary"
ANSWER = "dest int, docs binary, runs binary"
GATHERED = "k bigint, th bigint, runs binary"


class Unit(Protocol):
    """What a window is made of."""

    length: int  # of a window
    gram: int  # of an anchor

    def values(self, text: str) -> np.ndarray:
        """A uint64 value for each word or byte."""


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k, th, text), dealt out by key: one exchange for all steps."""
    text = text_or_empty(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), id_order(F.col(id_col)).alias("k"),
                       F.xxhash64(text).alias("th"), text.alias("text")).repartition("k", "th")


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Rows, a bounded amount of text at a time."""
    rows, held = [], 0
    for batch in batches:
        columns = [batch.column(c) for c in range(batch.num_columns)]
        for at in range(0, batch.num_rows, 100):
            for row in zip(*(c.slice(at, 100).to_pylist() for c in columns), strict=True):
                rows.append(row)
                held += len(row[2])
                if held >= size:
                    yield rows
                    rows, held = [], 0
    if rows:
        yield rows


def starts_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Where groups of equal neighbours begin."""
    if not len(sorted_keys):
        return np.empty(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1))


def repeat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... start + count - 1 of each, joined."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def documents_of(k: np.ndarray, th: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """DOC records for runs that are in order of doc."""
    first = starts_of(doc)
    out = np.empty(len(first), DOC)
    out["k"], out["th"] = k[doc[first]], th[doc[first]]
    out["runs"] = np.diff(np.append(first, len(doc)))
    return out


def answer(given: list[tuple[np.ndarray, np.ndarray]], dests: int) -> pa.RecordBatch:
    """What a bucket tells documents, (DOC records, their RUN records), as one
    row for each destination that gathers some of the documents."""
    docs = np.concatenate([d for d, _ in given] or [np.empty(0, DOC)])
    runs = np.concatenate([r for _, r in given] or [np.empty(0, RUN)])
    begin = np.cumsum(docs["runs"], dtype=np.int64) - docs["runs"]
    dest = (mix(docs["k"].astype(np.uint64) ^ docs["th"].astype(np.uint64)) % np.uint64(dests)).astype(np.int64)
    order = np.argsort(dest, kind="stable")
    edges = np.searchsorted(dest[order], np.arange(dests + 1))
    rows = []
    for d in range(dests):
        part = order[edges[d]:edges[d + 1]]
        if len(part):
            rows.append((d, docs[part].tobytes(),
                         runs[repeat(begin[part], docs["runs"][part].astype(np.int64))].tobytes()))
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)],
        names=["dest", "docs", "runs"])


def gather_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document with all it was told (at most the document's own size)."""
    given = [(np.frombuffer(d, DOC), np.frombuffer(r, RUN)) for batch in batches
             for d, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
    if not given:
        return
    docs, runs = np.concatenate([d for d, _ in given]), np.concatenate([r for _, r in given])
    begin = np.cumsum(docs["runs"], dtype=np.int64) - docs["runs"]
    order = np.lexsort((docs["th"], docs["k"]))
    docs, runs = docs[order], runs[repeat(begin[order], docs["runs"][order].astype(np.int64))]
    first = np.concatenate(([0], np.flatnonzero((np.diff(docs["k"]) != 0) | (np.diff(docs["th"]) != 0)) + 1))
    count = np.add.reduceat(docs["runs"].astype(np.int64), first)
    for at in range(0, len(first), 10_000):
        few = first[at:at + 10_000]
        ends = np.cumsum(np.concatenate(([count[:at].sum()], count[at:at + 10_000])))
        values = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(few), [None, pa.py_buffer((ends * RUN.itemsize).astype(np.int64).tobytes()),
                                          pa.py_buffer(runs.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs["k"][few]), pa.array(docs["th"][few]), values.cast(pa.binary())], names=["k", "th", "runs"])


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        names=["bucket", "settled", "docs", "runs", "hashes", "known", "body"])


def settled_message(n: int, k: np.ndarray, th: np.ndarray, doc: np.ndarray, runs: np.ndarray) -> Iterator[tuple]:
    """Answers a task gives itself; they ride along to some bucket."""
    if len(doc):
        yield n, True, documents_of(k, th, doc).tobytes(), runs.tobytes(), b"", b"", b""


def send_anchors(unit: Unit, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for rows in chunks(b.select(["k", "th", "text"]) for b in batches):
            k = np.array([r[0] for r in rows], np.int64)
            th = np.array([r[1] for r in rows], np.int64)
            hashes, doc, first, n = [], [], [], []
            for d, (_, _, text) in enumerate(rows):
                h = window_hashes(unit.values(text), unit.gram)
                at, start, number = anchors(h, unit.length - unit.gram + 1)
                hashes.append(h[at])
                doc.append(np.full(len(at), d))
                first.append(start)
                n.append(number)
            h, doc = np.concatenate(hashes), np.concatenate(doc)
            runs = np.empty(len(h), RUN)
            runs["first"], runs["n"] = np.concatenate(first), np.concatenate(n)
            order = np.argsort(h)
            begin = starts_of(h[order])
            size = np.diff(np.append(begin, len(h)))
            alone = np.empty(len(h), bool)
            alone[order] = np.repeat(size == 1, size)
            known = h[order[begin[size > 1]]]
            out = list(settled_message(turn % buckets, k, th, doc[~alone], runs[~alone]))
            turn += 1
            single = np.flatnonzero(alone)
            bucket = (h[single] % np.uint64(buckets)).astype(np.int64)
            single = single[np.argsort(bucket, kind="stable")]
            edges = np.searchsorted(np.sort(bucket), np.arange(buckets + 1))
            known_bucket = known % np.uint64(buckets)
            known = known[np.argsort(known_bucket, kind="stable")]
            known_edges = np.searchsorted(np.sort(known_bucket), np.arange(buckets + 1))
            for b in range(buckets):
                part, more = single[edges[b]:edges[b + 1]], known[known_edges[b]:known_edges[b + 1]]
                if len(part) or len(more):
                    out.append((b, False, documents_of(k, th, doc[part]).tobytes(), runs[part].tobytes(),
                                h[part].tobytes(), more.tobytes(), b""))
            yield messages(out)

    return run


def answer_anchors(dests: int) -> Callable:
    """Tell documents which of their anchors occur elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, held, known = [], [], [np.empty(0, np.uint64)]
        for batch in batches:
            for _, settled, docs, runs, hashes, more, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs, runs = np.frombuffer(docs, DOC), np.frombuffer(runs, RUN)
                if settled:
                    given.append((docs, runs))
                else:
                    held.append((docs, runs, np.frombuffer(hashes, np.uint64)))
                    known.append(np.frombuffer(more, np.uint64))
        h = np.concatenate([x[2] for x in held] or [np.empty(0, np.uint64)])
        distinct, which, count = np.unique(h, return_inverse=True, return_counts=True)
        elsewhere = ((count > 1) | np.isin(distinct, np.concatenate(known)))[which]
        at = 0
        for docs, runs, hashes in held:
            given.append(select_runs(docs, runs, elsewhere[at:at + len(hashes)]))
            at += len(hashes)
        yield answer(given, dests)

    return run


def select_runs(docs: np.ndarray, runs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.repeat(np.arange(len(docs)), docs["runs"])[chosen]
    return documents_of(docs["k"], docs["th"], doc), runs[chosen]


def to_buckets(sent: DataFrame, buckets: int) -> DataFrame:
    return sent.repartitionById(buckets, F.col("bucket"))


def gathered(told: DataFrame, dests: int) -> DataFrame:
    return told.repartitionById(dests, F.col("dest")).mapInArrow(gather_answers, GATHERED)


def stretches(flags: np.ndarray, run: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring flagged windows of a run as (the run's number, RUN records),
    in records of MOST_WINDOWS and a rest where there are more."""
    at = np.flatnonzero(flags)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, RUN)
    new = np.concatenate(([True], (run[at[1:]] != run[at[:-1]]) | (place[at[1:]] != place[at[:-1]] + 1)))
    new |= (np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]) % MOST_WINDOWS == 0
    first = at[new]
    out = np.empty(len(first), RUN)
    out["first"] = place[first]
    out["n"] = np.diff(np.append(np.flatnonzero(new), len(at)))
    return run[first], out


def repeated_windows(docs: DataFrame, unit: Unit, send: Callable, settle: Callable) -> DataFrame:
    """(doc_id, k, th, text, runs): the documents (as ``keyed`` gives them) with
    the runs of repeated windows, null where there are none. ``send`` makes the
    mapper of step 2 for a number of buckets, ``settle`` is the reducer of step 3."""
    buckets = partitions(docs)
    candidates = gathered(to_buckets(docs.mapInArrow(send_anchors(unit, buckets), MESSAGE), buckets)
                          .mapInArrow(answer_anchors(buckets), ANSWER), buckets)
    sent = docs.join(candidates, ["k", "th"]).mapInArrow(send(buckets), MESSAGE)
    found = gathered(to_buckets(sent, buckets).mapInArrow(settle(buckets), ANSWER), buckets)
    return docs.join(found, ["k", "th"], "left")


def covered(runs: bytes | None, size: int, length: int) -> np.ndarray:
    """Which of ``size`` words or bytes lie in one of the windows."""
    if not runs:
        return np.zeros(size, bool)
    record = np.frombuffer(runs, RUN)
    edge = np.zeros(size + 1, np.int32)
    first = record["first"].astype(np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + record["n"] + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0
