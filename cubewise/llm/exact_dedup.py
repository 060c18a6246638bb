"""Exact de-duplication by composable polynomial fingerprints.

Texts are compared after every run of white space became one space. A text is
hashed in chunks: all chunks of an Arrow batch are hashed side by side, and a
text's fingerprint is folded from its chunks by length-shifted arithmetic,
``h(a + b) = h(a) * base**len(b) + h(b)``, in two prime fields. So a huge
document's chunks can be hashed anywhere and in any order.

Rows with equal length and fingerprints are then compared for real: the rows
of such a group are cut into chunks again, each chunk is joined with the same
chunk of the group's first row, and a row is a copy if all its chunks are equal.
Rows that differ (a collision) form groups of their own in the next round, until
none differs. A Bloom filter of the ids to compare keeps the other texts from being
hashed again or moved; of a group's texts a chunk at a time is moved, and a group of
any size meets its first row by a join that Spark can split.

Defined cases: a null text counts as empty; empty texts equal one another (a
text of white space alone equals a single space); a repeated row (same id, same
text) appears as often as it came, and one of them is kept at most; rows
without an id rank after all others; an empty table gives no rows; other
columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.bloom import keys_test, split_rows
from cubewise.llm.byte_bpe import small_batches
from cubewise.llm.common import LAST_ID, by_name, by_number, id_order, lean, stored, text_or_empty

# Two Mersenne-like primes below 2**31 and a base for each; a chunk's products
# and sums stay below 2**53, where float64 arithmetic is exact.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
CHUNK = 1 << 14
# Bytes of a chunk that is moved to be compared.
COMPARED = 1 << 20

# Runs of white space, except a lone space, which stays as it is.
_RUNS = re.compile(rb"[ \t-\r]{2,}|[\t-\r]")


def normalise(text: str) -> bytes:
    return _RUNS.sub(b" ", text.encode("utf-8"))


def chunk_table(primes: tuple[int, int] = PRIMES) -> np.ndarray:
    """base**(CHUNK-1) .. base**0 in each field, as columns."""
    columns = []
    for base, prime in zip(BASES, primes, strict=True):
        powers = [1]
        for _ in range(CHUNK - 1):
            powers.append(powers[-1] * base % prime)
        columns.append(powers[::-1])
    return np.array(columns, np.float64).T.copy()


def chunk_hashes(texts: list[bytes], table: np.ndarray, primes: tuple[int, int]) -> list[list[tuple[int, int, int]]]:
    """For each text its chunks' (length, hash, hash), hashed side by side. A
    short chunk is padded in front, which leaves its polynomial unchanged."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    rows = [(n, at) for n, t in enumerate(texts) for at in range(0, len(t), CHUNK)]
    for first in range(0, len(rows), 64):
        part = rows[first:first + 64]
        width = max(min(CHUNK, len(texts[n]) - at) for n, at in part)
        grid = np.zeros((len(part), width), np.float64)
        lengths = []
        for i, (n, at) in enumerate(part):
            piece = np.frombuffer(texts[n], np.uint8, min(CHUNK, len(texts[n]) - at), at)
            # 1..256, so that leading zero bytes count.
            grid[i, width - len(piece):] = piece
            grid[i, width - len(piece):] += 1
            lengths.append(len(piece))
        sums = grid @ table[CHUNK - width:]
        for (n, _), length, (x, y) in zip(part, lengths, sums.tolist(), strict=True):
            out[n].append((length, int(x) % primes[0], int(y) % primes[1]))
    return out


def combine(chunks: list[tuple[int, int, int]], primes: tuple[int, int] = PRIMES) -> tuple[int, int, int]:
    """Fingerprint of a concatenation from its parts' fingerprints, in order."""
    length, x, y = 0, 0, 0
    for n, a, b in chunks:
        length += n
        x = (x * pow(BASES[0], n, primes[0]) + a) % primes[0]
        y = (y * pow(BASES[1], n, primes[1]) + b) % primes[1]
    return length, x, y


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 primes: tuple[int, int] = PRIMES, texts: bool = False,
                 wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(doc_id, rank, length, hash1, hash2) and either text_sha256 or, with
    ``texts``, the normalised text; rank is the id with nulls last. ``wanted``: of which
    ranks rows are made (told in the same Python worker: a filter of its own would
    take a second worker a task)."""
    fields = f"doc_id {dict(docs.dtypes)[id_col]}, rank bigint, length bigint, hash1 bigint, hash2 bigint"
    fields += ", body binary" if texts else ", text_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(primes)
        for batch in small_batches(batches):
            if wanted:
                batch = batch.filter(pa.array(wanted(batch.column(1).to_numpy(zero_copy_only=False))))
            bodies = [normalise(t) for t in batch.column(2).to_pylist()]
            prints = [combine(c, primes) for c in chunk_hashes(bodies, table, primes)]
            columns = [pa.array([p[n] for p in prints], pa.int64()) for n in range(3)]
            last = (pa.array(bodies, pa.binary()) if texts
                    else pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns, last], names=[f.split()[0] for f in fields.split(", ")])

    return (docs.select(F.col(id_col).alias("doc_id"), id_order(F.col(id_col)).alias("rank"),
                        text_or_empty(F.col(text_col)).alias("text"))
            .mapInArrow(lean(run), fields))


PRINT = ["length", "hash1", "hash2"]


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            primes: tuple[int, int] = PRIMES) -> DataFrame:
    """(doc_id, rank, text_sha256, n, compared, keep_rank, class_text): one row for
    each (id, text) with the number n of such rows, whether its fingerprint is
    shared, and its class's first rank and text."""
    rows = stored(fingerprints(docs, id_col, text_col, primes)
                  .groupBy("doc_id", "rank", *PRINT, "text_sha256").agg(F.count("*").alias("n")), "fingerprints")
    # Stored, so that the join below has plain exchanges on both sides: only then does
    # adaptive execution split the rows of a hot fingerprint over several tasks.
    several = stored(rows.groupBy(*PRINT).agg(F.min("rank").alias("first"), F.count("*").alias("rows"))
                     .where("rows > 1").drop("rows"), "several")
    # Ids (not texts) of the rows to compare; the text comes with the row itself.
    to_compare = stored(rows.join(several, PRINT).select("rank", *PRINT, "first").distinct(), "to_compare")
    inside = keys_test(to_compare.select("rank"))
    bodies = fingerprints(docs, id_col, text_col, primes, texts=True, wanted=inside)
    pieces = stored(
        bodies.join(to_compare, ["rank", *PRINT])
        .select("rank", "first", *PRINT, F.sha2("body", 256).alias("text_sha256"), "body")
        .dropDuplicates(["rank", *PRINT, "text_sha256"])
        .select("rank", "first", *PRINT, "text_sha256", F.explode(F.transform(
            F.sequence(F.lit(0), F.greatest(F.col("length").cast("int") - 1, F.lit(0)), F.lit(COMPARED)),
            lambda at: F.struct(at.alias("at"), F.substring("body", at + 1, F.lit(COMPARED)).alias("chunk")))).alias("c"))
        .select("rank", "first", *PRINT, "text_sha256", "c.at", "c.chunk"), "pieces")
    settled = compare(pieces)
    return (rows.join(settled, ["rank", *PRINT, "text_sha256"], "left")
            .withColumn("compared", F.col("class_rank").isNotNull())
            .withColumn("keep_rank", F.coalesce("class_rank", "rank"))
            .withColumn("class_text", F.coalesce("class_text", "text_sha256"))
            .drop("class_rank"))


def compare(pieces: DataFrame) -> DataFrame:
    """(rank, fingerprint, text_sha256, class_rank, class_text): each compared
    row's class, named by its first row. Every round compares what is left of a
    group with the first of it."""
    key = ["rank", *PRINT, "text_sha256"]
    settled, left = None, pieces
    while True:
        # The first row of a group; equal ranks (one id, two texts) by digest.
        first = left.groupBy(*PRINT).agg(F.min(F.struct("rank", "text_sha256")).alias("head"))
        headed = left.join(first, PRINT)
        heads = (headed.where("rank = head.rank and text_sha256 = head.text_sha256")
                 .select(*PRINT, "at", F.col("chunk").alias("head_chunk")))
        verdict = stored(
            headed.join(heads, [*PRINT, "at"])
            .groupBy(*key, "head").agg(F.min(F.col("chunk") == F.col("head_chunk")).alias("equal")), "compared")
        equal = verdict.where("equal").select(
            *key, F.col("head.rank").alias("class_rank"), F.col("head.text_sha256").alias("class_text"))
        settled = equal if settled is None else settled.unionByName(equal)
        differ = verdict.where("not equal").select(*key)
        if differ.isEmpty():
            return settled
        left = stored(left.join(differ, key), "left")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                primes: tuple[int, int] = PRIMES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row a document."""
    return fates(stored(classes(docs, id_col, text_col, primes), "classes"))


def fates(rows: DataFrame) -> DataFrame:
    """``deduplicate``'s rows from stored ones of ``classes``. Rows whose fingerprint is
    theirs alone need no join with their group's size."""
    alone, grouped = rows.where("not compared"), rows.where("compared")
    # Stored for the same reason as the shared fingerprints in ``classes``.
    groups = stored(grouped.groupBy("keep_rank", "class_text").agg(F.sum("n").alias("group_size")), "groups")
    sized = (grouped.join(groups, ["keep_rank", "class_text"])
             .unionByName(alone.withColumn("group_size", F.col("n"))))
    id_type = dict(rows.dtypes)["doc_id"]
    return (sized.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))
            .select("doc_id",
                    F.when(F.col("keep_rank") != LAST_ID, F.col("keep_rank")).cast(id_type).alias("keep_id"),
                    "group_size",
                    ((F.col("rank") == F.col("keep_rank")) & (F.col("nth") == 1)).alias("kept"),
                    "text_sha256"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns. Equal rows of one id
    and text are reduced to one."""
    rows = stored(classes(docs, id_col, text_col), "classes")
    kept = fates(rows).where("kept").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("rank"), F.col("text_sha256").alias("sha"))
    doc_id, text = (F.col(f"_{docs.columns.index(c)}") for c in (id_col, text_col))
    body = F.regexp_replace(text_or_empty(text), "[\\x20\\x09-\\x0D]+", " ")
    # Rows that share neither text nor id and text stay where they are.
    single, contested = split_rows(by_number(docs), id_order(doc_id), rows.where("compared or n > 1").select("rank"))
    judged = (contested.withColumn("rank", id_order(doc_id)).withColumn("sha", F.sha2(F.encode(body, "UTF-8"), 256))
              .join(kept, ["rank", "sha"], "left_semi").dropDuplicates(["rank", "sha"]).drop("rank", "sha"))
    return by_name(single.unionByName(judged), docs)
