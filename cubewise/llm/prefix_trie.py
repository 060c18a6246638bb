"""Conversation prefix trie with aggregates for every node.

A node is a distinct sequence of first turns; a turn is known by the first 16
bytes of the SHA-256 of its role and text. Conversations are dealt by ranges of
their turn sequences, so every node's members lie in one shard or in
neighbouring ones. A shard forms padded matrices of turn ids (conversations x
depths), sorts them with numpy's lexsort, ORs the column changes from left to
right, so that a mark says where a node starts at each depth, and aggregates
every depth with reduceat, deepest first. Nodes that hold a shard's first or last
conversation may go on next door: their partial figures are recombined in Spark
by node, and subtree sums climb the few recombined nodes by pointer jumping
(rounds as the logarithm of the depth).

Long conversations are not held whole. Bands of depths end at 32, 64, 128, ...;
what a conversation has beyond the first band end at which no other shares its
turns so far is a plain chain of nodes of its own, generated from its length.
(Sharing is decided by a hash of the turns so far: equal sequences always have
equal hashes, so no shared node is missed.) A matrix row is therefore at most
twice as long as what two conversations share, or 32; matrices are formed
band by band.

Defined cases: rows without a conversation id belong to no conversation; a null
role or text is empty; turns sort by turn (nulls first), equal ones by role and
text, and repeated rows are turns of their own; c - c % 100 takes the remainder
with c's sign; an empty table has no conversation and no node; a text's length
has no bound; other columns are ignored, so their names cannot clash. A node's
``ends_sha256`` is one sequential digest: the ids stream through one task in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cubewise.llm.common import partitions, stored
from cubewise.llm.shards import in_shards, shard_number

# Conversations of one hundred share the turns of their first; at most this many.
SHARED_TURNS = 5
# Depth at which the first band ends; later bands double.
BAND = 32
# Turns of one conversation that are dealt together.
BLOCK = 4096
# Chain nodes that one row generates.
CHAIN = 65536
# Recombined nodes up to which their ids go to every task.
SMALL = 100_000
# Conversation ids in one chunk of a node's ends.
ENDS = 10_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]
CLOSED, OPEN, ENDING = 0, 1, 2
SHARD = f"{NODE}, kind int, key binary, parent_key binary, chars bigint, ends string"


def trie(turns: DataFrame) -> DataFrame:
    """One row a node of the rebuilt conversations of turns (conv_id, turn, role, text)."""
    return nodes(*rebuilt(turns))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos from 0, id, chars): every turn's place in its conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = (turns.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
            .withColumn("id", F.unhex(F.substring(F.sha2(F.encode(content, "UTF-8"), 256), 1, 32)))
            .withColumn("chars", F.char_length("text").cast("long")))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, current, first = shard_number(), 0, None, None
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            first = int(conv[0]) if first is None else first
            starts = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
            pos = np.arange(len(conv)) - np.repeat(starts, np.diff(starts, append=len(conv)))
            if current == conv[0]:
                pos[:starts[1] if len(starts) > 1 else len(pos)] += at
            current, at = int(conv[-1]), int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(pos, pa.int64()),
                 pa.array(np.full(len(conv), shard, np.int32)), pa.array(conv == first)],
                names=["conv_id", "id", "chars", "local", "shard", "head"])

    placed = stored(in_shards(rows, ["conv_id", "turn", "id", "chars"], ("role", "text")).select("conv_id", "id", "chars")
                    .mapInArrow(places, "conv_id bigint, id binary, chars bigint, local bigint, shard int, head boolean"), "turns")
    # Only a shard's first conversation can have begun elsewhere: one row a shard.
    heads = placed.where("head").select("conv_id", "shard").distinct()
    counts = (placed.join(F.broadcast(heads.select("conv_id").distinct()), "conv_id")
              .groupBy("conv_id", "shard").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("conv_id", "shard", before.alias("before")).join(F.broadcast(heads), ["conv_id", "shard"], "left_semi")
    return (placed.join(F.broadcast(offsets), ["conv_id", "shard"], "left")
            .select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): the turns (conv_id, depth from 1, id, chars, length) of
    the rebuilt conversations, and (conv_id, length) for all of them."""
    rows = stored(numbered(turns), "numbered")
    is_base = F.col("conv_id") % 100 == 0
    kept = F.when(is_base & (F.col("pos") < SHARED_TURNS), F.struct("pos", "id", "chars"))
    own = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(kept)).alias("first"))
    base = own.where(is_base).select(F.col("conv_id").alias("base"), F.col("first").alias("shared"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % (SHARED_TURNS + 1)).cast("int")
    convs = stored(
        own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h.alias("h"))
        .join(base, "base", "left")
        .withColumn("shared", F.when(F.col("shared").isNotNull(), F.slice("shared", 1, F.col("h"))).otherwise(F.array()))
        .withColumn("length", F.size("shared") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "convs")
    head = (convs.select("conv_id", "length", F.posexplode("shared").alias("at", "turn"))
            .select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "turn.id", "turn.chars", "length"))
    # Blocks spread a conversation of any length over tasks.
    by_block = convs.select("conv_id", "h", (F.size("shared") - F.col("h")).alias("shift"), "length",
                            F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {BLOCK}"))).alias("block"))
    tail = (rows.withColumn("block", F.expr(f"pos div {BLOCK}")).join(by_block, ["conv_id", "block"]).where("pos >= h")
            .select("conv_id", (F.col("pos") + 1 + F.col("shift")).alias("depth"), "id", "chars", "length"))
    return stored(head.unionByName(tail), "rebuilt"), convs.select("conv_id", "length")


def band_of(depth: Column) -> Column:
    """0 for depths to BAND, 1 to twice that, and so on."""
    q = F.floor((depth - 1) / BAND)
    return F.when(q == 0, 0).otherwise(F.length(F.bin(q)))


def widths(rows: DataFrame) -> DataFrame:
    """(conv_id, width) of conversations that share their turns beyond the first
    band's end: the band end from which on they are alone."""
    bands = (rows.where(F.col("length") >= BAND).groupBy("conv_id", "length", band_of(F.col("depth")).alias("band"))
             .agg(F.bit_xor(F.xxhash64("depth", "id")).alias("hash")))
    so_far = F.bit_xor("hash").over(Window.partitionBy("conv_id").orderBy("band"))
    prefixes = (bands.withColumn("prefix", so_far).withColumn("ends", F.expr(f"{BAND} * shiftleft(1L, band)"))
                .where("length >= ends"))
    shared = prefixes.groupBy("band", "prefix").agg(F.count("*").alias("n")).where("n > 1")
    return (prefixes.join(shared, ["band", "prefix"], "left_semi").groupBy("conv_id")
            .agg((2 * F.max("ends")).alias("width")))


def nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's nodes from the turns and the lengths of conversations."""
    wide = stored(widths(rows), "widths")
    turn = F.struct("depth", "id", "chars")
    near = rows.where(F.col("depth") <= BAND).select("conv_id", turn.alias("turn"))
    far = (rows.where(F.col("depth") > BAND).join(wide, "conv_id").where("depth <= width").select("conv_id", turn.alias("turn")))
    marks = convs.join(wide, "conv_id", "left").select(
        "conv_id", "length", F.coalesce("width", F.lit(BAND).cast("long")).alias("width"))
    mark = marks.select("conv_id", F.lit(None).cast(near.schema["turn"].dataType).alias("turn"),
                        (F.col("length") > F.col("width")).alias("cut"))
    paths = (near.unionByName(far).withColumn("cut", F.lit(False)).unionByName(mark).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list("turn")).alias("turns"), F.max("cut").alias("cut"))
             .select("conv_id", "cut", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars")))
    schema = to_arrow_schema(T.StructType.fromDDL(SHARD))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from shard_nodes(pa.Table.from_batches(held), schema)

    found = stored(paths.repartitionByRange(partitions(rows), "ids", "conv_id").mapInArrow(shard, SHARD), "nodes")
    opened = recombined(found)
    parents = opened.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("known"))
    closed = found.where(F.col("kind") == CLOSED)
    if opened.count() <= SMALL:
        closed = closed.join(F.broadcast(parents), "parent_key", "left")
    else:  # a parent may have any number of children: deal them over copies of the parents
        salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        closed = (closed.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(64)).cast("int"))
                  .join(salted, ["parent_key", "salt"], "left"))
    closed = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "known"))
    return (closed.select(NODE_COLUMNS).unionByName(opened.select(NODE_COLUMNS))
            .unionByName(chains(marks.where("length > width")).select(NODE_COLUMNS)))


def chains(marks: DataFrame) -> DataFrame:
    """The nodes of conversations (conv_id, length, width) beyond their width."""
    blocks = marks.select("conv_id", "length", "width", F.explode(F.sequence(
        F.lit(0), F.expr(f"(length - width - 1) div {CHAIN}"))).alias("block")).repartition(partitions(marks))
    first = F.col("width") + 1 + F.col("block") * CHAIN
    last = F.col("depth") == F.col("length")
    return (blocks.select("conv_id", "length", F.explode(F.sequence(first, F.least(F.col("length"), first + CHAIN - 1))).alias("depth"))
            .select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                    F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                    F.lit(0).cast("long").alias("saved_tokens"),
                    F.when(last, F.sha2(F.encode(F.col("conv_id").cast("string"), "UTF-8"), 256)).otherwise(NO_ENDS).alias("ends_sha256")))


class Matrix:
    """A shard's conversations, sorted by their turns and then their ids."""

    def __init__(self, conv: np.ndarray, cut: np.ndarray, lens: np.ndarray, codes: np.ndarray, chars: np.ndarray):
        starts = np.cumsum(lens) - lens
        order = np.lexsort((conv, self.ranks(lens, starts, codes)))
        self.conv, self.cut, self.lens, self.starts = conv[order], cut[order], lens[order], starts[order]
        self.codes, self.chars = codes, chars
        self.common = self.shared_turns()

    @staticmethod
    def padded(rows: np.ndarray, lens: np.ndarray, starts: np.ndarray, codes: np.ndarray, low: int, width: int) -> np.ndarray:
        """Turn ids of some rows at depths low + 1 to low + width, -1 behind their end."""
        counts = np.minimum(lens[rows] - low, width)
        r = np.repeat(np.arange(len(rows)), counts)
        c = np.arange(len(r)) - np.repeat(np.cumsum(counts) - counts, counts)
        out = np.full((len(rows), width), -1, np.int64)
        out[r, c] = codes[starts[rows][r] + low + c]
        return out

    @classmethod
    def bands(cls, lens: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
        low = 0
        while len(rows := np.flatnonzero(lens > low)):
            width = int(min(max(BAND, low), lens[rows].max() - low))
            yield rows, low, width
            low += width

    @classmethod
    def ranks(cls, lens: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Equal for equal turn sequences, in their order; refined band by band."""
        rank = np.zeros(len(lens), np.int64)
        for rows, low, width in cls.bands(lens):
            matrix = cls.padded(rows, lens, starts, codes, low, width)
            order = np.lexsort((*matrix.T[::-1], rank[rows]))
            matrix, of = matrix[order], rank[rows][order]
            new = np.r_[True, (matrix[1:] != matrix[:-1]).any(axis=1) | (of[1:] != of[:-1])]
            within = np.zeros(len(lens), np.int64)
            within[rows[order]] = np.cumsum(new)
            _, rank = np.unique(rank * (len(lens) + 1) + within, return_inverse=True)
        return rank

    def shared_turns(self) -> np.ndarray:
        """How many first turns a row has in common with the row before it: the
        depths whose change marks, ORed from the left, are still unset. The first
        row has none, not even the root."""
        common = np.zeros(len(self.lens), np.int64)
        for rows, low, width in self.bands(self.lens):
            matrix = self.padded(rows, self.lens, self.starts, self.codes, low, width)
            here = np.flatnonzero((np.diff(rows, prepend=-2) == 1) & (common[rows] == low))
            marks = np.logical_or.accumulate(matrix[here] != matrix[here - 1], axis=1)
            both = np.minimum(self.lens[rows[here]], self.lens[rows[here] - 1])
            common[rows[here]] = np.minimum(low + (~marks).sum(axis=1), both)
        common[:1] = -1
        return common


def shard_nodes(table: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard's conversations: closed ones whole, open ones in part."""
    table = table.combine_chunks()
    ids = table["ids"].combine_chunks()
    lens = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    raw = b"".join(ids.flatten().to_pylist())
    halves = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    codes = np.zeros(len(halves), np.int64)
    if len(halves):
        codes[order] = np.cumsum(np.r_[False, (halves[order][1:] != halves[order][:-1]).any(axis=1)])
    chars = table["chars"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    m = Matrix(table["conv_id"].to_numpy(), table["cut"].to_numpy(), lens, codes, chars)

    edges = [open_keys(raw, m, 0), open_keys(raw, m, len(m.lens) - 1)]
    last = len(m.lens) - 1
    leaves, saved = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
    below: dict | None = None
    for depth in range(int(m.lens.max()), -1, -1):
        rows = np.flatnonzero(m.lens >= depth)
        at = np.flatnonzero(m.common[rows] < depth)
        first = rows[at]
        total = lambda x: np.add.reduceat(x, at)
        n_convs = np.diff(at, append=len(rows))
        ending = m.lens[rows] == depth
        cut = total((ending & m.cut[rows]).astype(np.int64))
        children = total(((m.lens[rows] > depth) & (m.common[rows] <= depth)).astype(np.int64))
        least = np.minimum.reduceat(m.conv[rows], at)
        length = m.chars[m.starts[first] + depth - 1] if depth else np.zeros(1, np.int64)
        is_open = np.zeros(len(at), bool)
        if rows[0] == 0:
            is_open[0] = True
        if rows[-1] == last:
            is_open[-1] = True
        key = [None] * len(at)
        for n, edge in ((len(at) - 1, 1), (0, 0)):
            if is_open[n] and (rows[-1] == last if edge else rows[0] == 0):
                key[n] = edges[edge][depth]
        # A closed node adds its own share where it starts; an open one when recombined.
        shut = first[~is_open]
        leaves[shut] += ((children == 0) & (cut == 0))[~is_open]
        saved[shut] += ((n_convs - 1) * length)[~is_open]
        leaves[first] += cut
        hexes, ends = digests(m.conv[rows], ending & ~m.cut[rows], at, n_convs, is_open)
        here = {"conv_id": least, "depth": np.full(len(at), depth), "n_convs": n_convs, "n_children": children + cut,
                "n_leaves": total(leaves[rows]), "saved_tokens": total(saved[rows]), "chars": length,
                "ends_sha256": hexes, "first": first, "open": is_open, "key": key}
        # What an open node reports is not reported again by the nodes above it.
        reported = np.repeat(is_open, n_convs)
        leaves[rows[reported]] = saved[rows[reported]] = 0
        if below is not None:
            parent = np.searchsorted(first, below["first"], "right") - 1
            np.subtract.at(here["n_children"], parent[below["open"]], 1)
            yield batch_of(below, least[parent], is_open[parent], [key[p] for p in parent], schema)
        if ends:
            yield pa.RecordBatch.from_pydict(
                {f.name: {"kind": [ENDING] * len(ends), "key": [key[n] for n, _, _ in ends], "conv_id": [c for _, c, _ in ends],
                          "ends": [e for _, _, e in ends]}.get(f.name, [None] * len(ends)) for f in schema}, schema=schema)
        below = here
    yield batch_of(below, np.zeros(1, np.int64), np.ones(1, bool), [None], schema)


def open_keys(raw: bytes, m: Matrix, row: int) -> list[bytes]:
    """Keys of the nodes that hold a row, by depth."""
    keys, digest = [b""], hashlib.sha256()
    start = int(m.starts[row]) * 16
    for d in range(int(m.lens[row])):
        digest.update(raw[start + 16 * d:start + 16 * d + 16])
        keys.append(digest.digest()[:16])
    return keys


def digests(conv: np.ndarray, ending: np.ndarray, at: np.ndarray, n: np.ndarray,
            is_open: np.ndarray) -> tuple[list[str], list[tuple[int, int, str]]]:
    """Each node's digest of the conversations that end there, and for open nodes
    (node, first id, ids) in chunks."""
    counts = np.add.reduceat(ending.astype(np.int64), at)
    hexes, chunks = [NO_ENDS] * len(at), []
    ids = conv[ending].tolist()
    places = np.cumsum(counts) - counts
    for node in np.flatnonzero(counts).tolist():
        own = ids[places[node]:places[node] + counts[node]]
        if is_open[node]:
            chunks += [(node, own[i], ",".join(map(str, own[i:i + ENDS]))) for i in range(0, len(own), ENDS)]
        else:
            hexes[node] = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
    return hexes, chunks


def batch_of(found: dict, parent: np.ndarray, unknown: np.ndarray, parent_key: list, schema: pa.Schema) -> pa.RecordBatch:
    n = len(found["conv_id"])
    columns = {**found, "kind": np.where(found["open"], OPEN, CLOSED), "parent_key": parent_key,
               "parent_conv_id": pa.array(parent, pa.int64(), mask=np.asarray(unknown)), "ends": [None] * n}
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name] for f in schema], schema=schema)


def recombined(found: DataFrame) -> DataFrame:
    """The open nodes of all shards, whole: NODE columns and key."""
    parts = found.where(F.col("kind") == OPEN)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = stored(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
        F.first("chars").alias("chars"), *sums), "open")
    children = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    merged = stored(
        merged.join(children, "key", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        .withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).drop("more"), "open")

    # After k rounds a node has the sums of its subtree down to 2**k - 1 levels below.
    deepest = merged.agg(F.max("depth")).first()[0] or 0
    state = merged.select("key", F.col("parent_key").alias("jump"), "n_leaves", "saved_tokens")
    for _ in range(int(deepest).bit_length()):
        risen = (state.where("jump is not null").groupBy(F.col("jump").alias("key"))
                 .agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")))
        further = state.select(F.col("key").alias("jump"), F.col("jump").alias("next"))
        state = stored(state.join(risen, "key", "left").join(further, "jump", "left").select(
            "key", F.col("next").alias("jump"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")), "rising")

    schema = to_arrow_schema(T.StructType.fromDDL("key binary, ends_sha256 string"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            for k, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if digest:
                        yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest.hexdigest()]}, schema=schema)
                    key, digest = k, hashlib.sha256(chunk.encode())
                else:
                    digest.update(b"," + chunk.encode())
        if digest:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest.hexdigest()]}, schema=schema)

    ends = (found.where(F.col("kind") == ENDING).select("key", "ends", "conv_id").repartition("key")
            .sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(hashed, "key binary, ends_sha256 string"))
    up = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return stored(merged.drop("n_leaves", "saved_tokens").join(state.drop("jump"), "key").join(ends, "key", "left")
                  .join(up, "parent_key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
                  .select(*NODE_COLUMNS, "key"), "open")
