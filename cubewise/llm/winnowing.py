"""Document fingerprints by winnowing.

Every k code points are hashed by a rolling hash; of every w consecutive hashes
the smallest is chosen, the rightmost on ties, and kept with its position. Any
common passage of at least ``w + k - 1`` code points therefore shares a chosen
hash, and no passage shorter than k does. The likeness of two fingerprints is
the share of chosen hashes they have in common, 2 |A and B| / (|A| + |B|).

``compare_neighbours`` fingerprints each document and an edited text that ends
with the beginning of the next document, in descending order of id. The rows are
range-partitioned and sorted; a task streams over its range and holds two
documents at a time. The last document of a range meets the first of the next
range in a second, small step over two rows a range.

Defined cases: a null text counts as empty; an empty text has no hashes, and two
empty fingerprints have likeness 1; a text of fewer than k code points is hashed
as a whole; rows with one id follow in the order of a hash of their text, rows
without an id come last; the next of a lone document is itself; an empty table
gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubewise.llm.byte_bpe import lists, small_batches
from cubewise.llm.common import partitions, stored, text_or_empty
from cubewise.llm.rolling import anchors, window_hashes

GRAM = 12
WINDOW = 9
FIRST_ID = -(1 << 63)


class Fingerprint(NamedTuple):
    hashes: np.ndarray
    positions: np.ndarray

    def digest(self) -> str:
        return xxhash.xxh3_128_hexdigest(self.hashes.tobytes() + self.positions.astype("<u4").tobytes())


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> Fingerprint:
    """The chosen hashes and where they start, in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    if not len(points):
        return Fingerprint(np.empty(0, np.uint64), np.empty(0, np.int64))
    points += np.uint64(1)
    h = window_hashes(points, min(gram, len(points)))
    at = anchors(h, min(window, len(h)))[0]
    return Fingerprint(h[at], at)


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    x, y = np.unique(a.hashes), np.unique(b.hashes)
    if not len(x) and not len(y):
        return 1.0
    return 2 * len(np.intersect1d(x, y, assume_unique=True)) / (len(x) + len(y))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions), one row a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            prints = [winnow(t, gram, window) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists([p.hashes.view(np.int64) for p in prints], pa.int64()),
                 lists([p.positions for p in prints], pa.int64())], names=["doc_id", "hashes", "positions"])

    return (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
            .mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, hashes array<bigint>, positions array<bigint>"))


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following one."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


RESULT = ["n_chars bigint", "edited_sha256 string", "fingerprint string", "edited_fingerprint string",
          "near_edited double", "near_next double"]


def result(text: str, own: Fingerprint, following: str, theirs: Fingerprint) -> tuple:
    edited = edited_text(text, following)
    other = winnow(edited)
    return (len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), own.digest(), other.digest(),
            likeness(own, other), likeness(own, theirs))


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row a document."""
    id_type = dict(docs.dtypes)[id_col]
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)).alias("rank"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))
    order = [F.col("rank").desc(), F.col("text_hash").desc()]
    # end: the row begins or ends its range; its text and place go along.
    fields = f"doc_id {id_type}, rank bigint, text_hash bigint, end string, text string, " + ", ".join(RESULT)
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out = None, []
        for batch in small_batches(batches, 200):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = winnow(row[3])
                if before is None:
                    out.append((*row[:3], "first", row[3], *[None] * len(RESULT)))
                else:
                    out.append((*before[0][:3], None, None, *result(before[0][3], before[1], row[3], own)))
                before = row, own
            yield table(out)
            out = []
        if before is not None:
            yield table([(*before[0][:3], "last", before[0][3], *[None] * len(RESULT))])

    schema = pa.schema([("doc_id", pa_type(id_type)), ("rank", pa.int64()), ("text_hash", pa.int64()),
                        ("end", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                        ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64())])

    def table(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    streamed = stored(
        rows.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order).mapInArrow(run, fields), "ranges")

    # Two rows a range, without their texts, are put in order at once: the last
    # of a range is followed by the first of the next, in the end by the very first.
    ends = streamed.where("end is not null").select("rank", "text_hash", "end")
    line = Window.orderBy(F.col("rank").desc(), F.col("text_hash").desc(), F.col("end"))  # "first" < "last"
    # first, last, first, last, ...: rows 1 and 2 are range 0's, and the last of
    # range i meets the first of range i + 1, whose row number halves to the same.
    nth = ends.select("*", F.floor(F.row_number().over(line) / 2).alias("range"))
    ranges = nth.agg(F.max("range")).first()[0] or 0
    lasts = nth.where("end = 'last'").select("rank", "text_hash", F.pmod(F.col("range"), F.lit(max(ranges, 1))).alias("at"))
    firsts = nth.where("end = 'first'").select(F.col("rank").alias("r2"), F.col("text_hash").alias("h2"), F.col("range").alias("at"))
    pairs = lasts.join(firsts, "at")
    own = streamed.where("end = 'last'").select("doc_id", "rank", "text_hash", "text")
    other = streamed.where("end = 'first'").select(
        F.col("rank").alias("r2"), F.col("text_hash").alias("h2"), F.col("text").alias("following"))
    met = own.join(pairs, ["rank", "text_hash"]).join(other, ["r2", "h2"]).select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 50):
            out = [result(t, winnow(t), f, winnow(f))
                   for t, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in RESULT]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[5:], strict=True))],
                names=["doc_id", *names[5:]])

    tail = met.mapInArrow(finish, f"doc_id {id_type}, " + ", ".join(RESULT))
    return streamed.where("end is null").select("doc_id", *names[5:]).unionByName(tail)


def pa_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]
