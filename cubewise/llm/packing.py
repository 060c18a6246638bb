"""Best-fit packing of tokenised documents into sequences of fixed capacity.

A packing depends on the pieces' lengths alone, and there are at most
``capacity`` different lengths however large the corpus is. So Spark counts the
pieces of each length, the plan is made from those counts (at most ``capacity``
rows come to the driver), and Spark places every piece by its number among the
pieces of its length.

The plan follows Martello and Toth. First their dominance criterion: for a
piece, taken from the longest down, a set of at most three pieces that together
with it fills a sequence at least as well as every other set that could hold it
is fixed for good (``dominating_set``). Fixing a set never costs a sequence. It
shrinks the instance, and dominance is tried again until nothing changes. Best
fit, longest first, packs the rest. Equal lengths are handled by whole counts
in both steps, so the work depends on the capacity, not on the corpus.

Numbers within a length come from row numbers within (length, salt), the salt
a hash of the piece, plus the counts of the salts before; a length that holds
a third of all pieces is thereby spread over many tasks.

Defined cases: a null text counts as empty, and an empty text is one piece that
holds the end id alone; documents longer than the capacity are cut into full
pieces and a rest; rows without an id, repeated rows and ties are placed like
any others; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubewise.llm.byte_bpe import small_batches
from cubewise.llm.common import KEPT, lean, stored, text_or_empty
from cubewise.llm.pretokens import ChunkMemory, as_byte_characters, id_bytes, is_plain

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
# Words, and as many pieces of words, that a Python worker remembers.
MEMORY_WORDS = 800_000
# Pieces of one length numbered in one task, about.
ROWS_PER_SALT = 100_000

_loaded: dict[tuple[str, int], WordEncoder] = {}
KEPT["packing"] = _loaded


class WordEncoder:
    """One worker's tokenizer for a lower-casing, space-dropping vocabulary."""

    def __init__(self, vocabulary: str, memory: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The vocabulary's own split pattern; pieces keep no white space.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.pieces = ChunkMemory(self.encode_piece, memory)
        self.words = ChunkMemory(self.encode_word, memory)

    def encode_piece(self, piece: str) -> bytes:
        return id_bytes([t.id for t in self.model.tokenize(as_byte_characters(piece))])

    def encode_word(self, word: str) -> bytes:
        if not word:
            return b""
        if not is_plain(word):
            return id_bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)
        word = word.lower()
        if word.isalpha():
            return self.pieces[word]
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(word)))

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def word_encoder(vocabulary: str = VOCABULARY, memory: int = MEMORY_WORDS) -> WordEncoder:
    if (vocabulary, memory) not in _loaded:
        _loaded[vocabulary, memory] = WordEncoder(vocabulary, memory)
    return _loaded[vocabulary, memory]


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
        vocabulary: str = VOCABULARY, ids: bool = False, memory: int = MEMORY_WORDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and
    the end id, cut into pieces of at most ``capacity``. ``memory``: remembered words
    a worker; fewer cost time, not results."""
    fields = f"doc_id {dict(docs.dtypes)[id_col]}, piece int, start bigint, length bigint, ids_crc32 bigint"
    if ids:
        fields += ", ids array<int>"
    step, end = 4 * capacity, id_bytes([END_ID])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(vocabulary, memory)
        for batch in small_batches(batches):
            row, piece, start, length, crc, tokens = [], [], [], [], [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                raw = enc.encode(text) + end
                for k, at in enumerate(range(0, len(raw), step)):
                    part = raw[at:at + step]
                    row.append(n)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        tokens.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if ids:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    return (docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text"))
            .mapInArrow(lean(run, "packing"), fields))


class Run(NamedTuple):
    """Pieces first..first+count-1 of a length go, ``each`` to a sequence, into
    the sequences from ``sequence`` on, beginning at ``offset``."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


class Plan:
    """Runs of pieces, handed out in order."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[Run] = []
        self.taken = [0] * (capacity + 1)

    def open(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def place(self, length: int, sequence: int, count: int, each: int, offset: int) -> None:
        self.runs.append(Run(length, self.taken[length], count * each, sequence, each, offset))
        self.taken[length] += count * each


def dominating_set(counts: np.ndarray, length: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one piece of this length that dominates every feasible set
    with it, or None. ``counts`` includes the piece."""
    room = capacity - length
    others = counts.copy()
    others[length] -= 1
    present = np.flatnonzero(others[:room + 1])
    if not len(present):
        return (length,)
    best = int(present[-1])
    smallest = np.repeat(present[:3], np.minimum(others[present[:3]], 3))[:3].cumsum()
    # It fills the sequence, or nothing fits beside any one other piece.
    if best == room or len(smallest) < 2 or smallest[1] > room:
        return (length, best)
    if len(smallest) > 2 and smallest[2] <= room:
        return None
    # At most two others fit. The best two, and the longest that fits beside the best one.
    pair, low, high = 0, 0, len(present) - 1
    while low <= high:
        a, b = int(present[low]), int(present[high])
        if a + b > room or (low == high and others[a] < 2):
            high -= 1
        else:
            pair = max(pair, a + b)
            low += 1
    if best >= pair:
        return (length, best)
    others[best] -= 1
    second = np.flatnonzero(others[:room - best + 1])
    if not len(second):
        return None
    second = int(second[-1])
    between = np.arange(second + 1, best)
    between = np.repeat(between, np.minimum(others[second + 1:best], 2))[:2]
    if len(between) < 2 or between.sum() > room:
        return (length, best, second)
    return None


def fix_dominating(counts: np.ndarray, plan: Plan) -> None:
    """Fix dominating sets until there are none; ``counts`` keeps the rest."""
    changed = True
    while changed:
        changed = False
        for length in range(plan.capacity, 0, -1):
            while counts[length] and (chosen := dominating_set(counts, length, plan.capacity)):
                each = {s: chosen.count(s) for s in chosen}
                times = min(int(counts[s]) // n for s, n in each.items())
                first, offset = plan.open(times), 0
                for s, n in each.items():
                    plan.place(s, first, times, n, offset)
                    offset += s * n
                    counts[s] -= times * n
                changed = True


def best_fit(counts: np.ndarray, plan: Plan) -> None:
    """Best fit, longest first, of what is left. Sequences with the same room
    are kept as ranges; a piece goes where it leaves the least room."""
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(plan.capacity + 1)]
    for length in range(plan.capacity, 0, -1):
        left = int(counts[length])
        room = length
        while left:
            while room < plan.capacity and not ranges[room]:
                room += 1
            each = room // length
            if ranges[room]:
                first, size = ranges[room].pop()
            else:
                size = -(-left // each)
                first = plan.open(size)
            full = min(size, left // each)
            offset = plan.capacity - room
            if full:
                plan.place(length, first, full, each, offset)
                ranges[room - each * length].append((first, full))
                left -= full * each
            if full < size and left:
                plan.place(length, first + full, 1, left, offset)
                ranges[room - left * length].append((first + full, 1))
                left, full = 0, full + 1
            if full < size:
                ranges[room].append((first + full, size - full))
        counts[length] = 0


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for so many pieces of each length."""
    plan = Plan(capacity)
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        table[length] = n
    fix_dominating(table, plan)
    best_fit(table, plan)
    return plan


def number_within_length(pieces: DataFrame, total: int) -> DataFrame:
    """The pieces with ``rank``, their number among the pieces of their length."""
    salts = max(16, total // ROWS_PER_SALT)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").count()
              .withColumn("before", F.sum("count").over(
                  Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
              .select("length", "salt", F.coalesce("before", F.lit(0)).alias("before")))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    return (salted.withColumn("within", within).join(before, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("within") - 1).drop("salt", "within", "before"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (as ``cut`` gives them, read from storage: they are read twice)
    with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = make_plan(counts, capacity)
    runs = sorted(plan.runs)
    # Bounded by the capacity, not by the corpus.
    table = np.array(runs, np.int64).reshape(-1, 6)
    first_key = table[:, 0] * (1 << 50) + table[:, 1]

    numbered = number_within_length(pieces, sum(counts.values()))
    schema = ", ".join(f"{n} {t}" for n, t in numbered.drop("rank").dtypes) + ", sequence_id bigint, offset bigint"
    names = [c for c in numbered.columns if c != "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            length = batch.column("length").to_numpy()
            chosen = table[np.searchsorted(first_key, length * (1 << 50) + rank, "right") - 1]
            nth = rank - chosen[:, 1]
            sequence = chosen[:, 3] + nth // chosen[:, 4]
            offset = chosen[:, 5] + nth % chosen[:, 4] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, memory: int = MEMORY_WORDS) -> DataFrame:
    """Cut and pack; one row a piece."""
    return (pack(stored(cut(docs, capacity=capacity, memory=memory), "pieces"), capacity)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
