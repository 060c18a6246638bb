"""Conversations in turn order over range shards.

Rows are dealt by ranges of (conversation, turn, ...) and sorted within each
shard, so a conversation lies in one shard or in a run of neighbouring ones: one
that holds a third of all rows is spread over a third of the shards. In a shard
only the first and the last conversation can go on elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.common import partitions

# Characters of a role and a text that order rows of one turn; a hash decides beyond.
ORDERING_CHARS = 64


def in_shards(rows: DataFrame, columns: list[str], text_cols: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` of rows, dealt in ranges and sorted by (conv_id, turn, then the
    starts and a hash of text_cols), nulls first; equal rows part by their number,
    so copies without end are dealt too."""
    ties = [F.substring(c, 1, ORDERING_CHARS) for c in text_cols] + [F.xxhash64(*text_cols)] * bool(text_cols)
    numbered = rows.select(*columns, *[t.alias(f"_tie{n}") for n, t in enumerate(ties)],
                           F.monotonically_increasing_id().alias("_nr"))
    keys = ["conv_id", "turn", *[f"_tie{n}" for n in range(len(ties))], "_nr"]
    return numbered.repartitionByRange(partitions(rows), *keys).sortWithinPartitions(*keys).select(*columns)


def shard_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[dict], bool]]:
    """(conv_id, rows, whole) for the conversations of a shard's sorted rows;
    the first and the last may go on in another shard (whole is False)."""
    held: list[dict] = []
    first = True
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield held[0]["conv_id"], held, not first
                held, first = [], False
            held.append(row)
    if held:
        yield held[0]["conv_id"], held, False
