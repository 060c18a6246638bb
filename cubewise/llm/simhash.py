"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has bit i set if more than half of its word shingles' 64-bit
hashes have it. Documents link when their fingerprints differ in at most
``radius`` bits; a document's component is the smallest id reachable over links.

Equal fingerprints are one node from the start. Candidates come from the
pigeonhole principle: 64 bits in radius + 2 blocks, of which at least two agree
when at most radius bits differ; so each fingerprint is dealt once for every pair
of blocks, by the bits of that pair, and near ones meet at least once. In a
bucket the fingerprints are stored vertically, one bit plane for each bit. A
fingerprint is compared with 64 others by one machine word: planes that differ
are added into bit-sliced carry-save counters, and the block of others is
abandoned once every counter has passed the radius.

A bucket links its members by a spanning forest, so near-copies by the thousand
give links in proportion, not pairs. A bucket above ``BLOCK_ROWS`` is cut by hash
into parts, and each pair of parts is a task of its own.

Defined cases: a null or empty text, or one of white space, has no shingle and
fingerprint zero, which links like any other; fewer words than a shingle make one
shingle of them all; ties (half the hashes) leave a bit unset; repeated rows each
appear; rows without an id join components but never name one, unless all do (the
component is then null); an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.bloom import split_rows
from cubewise.llm.byte_bpe import small_batches
from cubewise.llm.common import LAST_ID, by_name, by_number, id_order, lean, stored, text_or_empty
from cubewise.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCK_ROWS = 4096

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, rank, text_hash, fp): the fingerprint as a signed 64-bit integer."""
    fields = f"doc_id {dict(docs.dtypes)[id_col]}, rank bigint, text_hash bigint, fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column(3).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(fps.view(np.int64))], names=["doc_id", "rank", "text_hash", "fp"])

    text = text_or_empty(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), id_order(F.col(id_col)).alias("rank"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(lean(run), fields)


def block_masks(radius: int) -> list[int]:
    """A mask for every pair of blocks: radius + 2 blocks cover the 64 bits, and
    with at most radius bits different some two blocks are equal."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(n)]
    masks = [blocks[i] | blocks[j] for i in range(n) for j in range(i + 1, n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words; bit j of word w in row i is bit i of fingerprint 64w + j."""
    padded = np.zeros((len(fps) + 63) // 64 * 64, np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within_radius(fp: int, planes: np.ndarray, order: np.ndarray, radius: int) -> np.ndarray:
    """Words whose set bits mark the fingerprints at most ``radius`` bits from fp.

    Counters are ``sliced`` vertically: counter bit k of all fingerprints is one
    row of words. Planes are added three at a time by a carry-save step; ``over``
    collects what has passed the radius, and the block is abandoned when all has."""
    width = planes.shape[1]
    bits = max(1, radius).bit_length()
    sliced = np.zeros((bits, width), np.uint64)
    over = np.zeros(width, np.uint64)
    full = ~np.uint64(0)

    def add(carry: np.ndarray, level: int) -> None:
        nonlocal over
        for k in range(level, bits):
            sliced[k], carry = sliced[k] ^ carry, sliced[k] & carry
        over |= carry

    for at in range(0, len(order), 3):
        rows = order[at:at + 3]
        differ = [~planes[i] if fp >> int(i) & 1 else planes[i] for i in rows]
        if len(differ) == 3:
            a, b, c = differ
            half = a ^ b
            add(half ^ c, 0)
            carry = (a & b) | (half & c)
            if bits > 1:
                add(carry, 1)
            else:
                over |= carry
        else:
            for a in differ:
                add(a, 0)
        if at % 12 == 9 and (over == full).all():
            return np.zeros(width, np.uint64)
    # Counters that did not overflow may still exceed a radius that is not 2**k - 1.
    above = np.zeros(width, np.uint64)
    equal = np.full(width, full)
    for k in reversed(range(bits)):
        if radius >> k & 1:
            equal &= sliced[k]
        else:
            above |= equal & sliced[k]
            equal &= ~sliced[k]
    return ~(over | above)


def near_links(left: np.ndarray, right: np.ndarray, shared: int, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two sorted blocks of fingerprints
    (or within one, when they are the same object). Bits that the bucket shares
    are not compared."""
    order = np.array([i for i in range(64) if not shared >> i & 1])
    planes = bit_planes(right)
    parent = np.arange(len(left) + (0 if left is right else len(right)))
    base = 0 if left is right else len(left)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i, fp in enumerate(left.tolist()):
        # Within one block, only later fingerprints are new.
        skip = (i + 1) // 64 if left is right else 0
        if skip >= planes.shape[1]:
            break
        words = within_radius(fp, planes[:, skip:], order, radius)
        if not words.any():
            continue
        near = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")) + 64 * skip
        for j in near[near < len(right)].tolist():
            if left is right and j <= i:
                continue
            a, b = root(i), root(base + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((fp, int(right[j])))
    return links


def links(nodes: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that make the same
    components as all pairs within the radius."""
    masks = block_masks(radius)
    dealt = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for n, m in enumerate(masks)])).alias("b")).select("fp", "b.mask", "b.bits")
    sizes = (dealt.groupBy("mask", "bits").count().where("count > 1")
             .select("mask", "bits", F.ceil(F.col("count") / block_rows).cast("int").alias("parts")))
    # Part p meets every part: each pair of parts (i <= j) is one task's two blocks.
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = (dealt.join(sizes, ["mask", "bits"]).withColumn("part", part)
           .select("fp", "mask", "bits", "part", F.explode(F.transform(
               F.sequence(F.lit(0), F.col("parts") - 1),
               lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j"))
           )).alias("pair"))
           .select("fp", "mask", "bits", "part", "pair.i", "pair.j"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        mask, _, i, j = key
        fps = rows["fp"].to_numpy().view(np.uint64)
        parts = rows["part"].to_numpy()
        left = np.sort(fps[parts == i])
        right = left if i == j else np.sort(fps[parts == j])
        found = near_links(left, right, masks[mask] & (1 << 64) - 1, radius)
        return pd.DataFrame(np.array(found, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return met.groupBy("mask", "bits", "i", "j").applyInPandas(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, rank, text_hash, fp, component, component_rank), one row a document."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("rank").alias("first")), "nodes")
    members = components(links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "component")
    named = nodes.join(members, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_rank"))
    return fps.join(named.join(smallest, "component").select("fp", "component", "component_rank"), "fp")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row a document."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    id_type = dict(found.dtypes)["doc_id"]
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component_rank") != LAST_ID, F.col("component_rank")).cast(id_type).alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, that of its smallest id, with all its
    columns (of rows that share the id, as of rows without one, the smallest text
    hash)."""
    found = stored(near_duplicates(docs, id_col, text_col).select("rank", "text_hash", "component", "component_rank"), "found")
    heads = (found.where("rank = component_rank")
             .groupBy("component").agg(F.min("rank").alias("rank"), F.min("text_hash").alias("text_hash"), F.count("*").alias("n")))
    # Rows alone in their component stay where they are.
    linked = found.where("rank <> component_rank")
    several = (linked.select("rank").unionByName(linked.select(F.col("component_rank").alias("rank")))
               .unionByName(heads.where("n > 1").select("rank")).distinct())
    doc_id, text = (F.col(f"_{docs.columns.index(c)}") for c in (id_col, text_col))
    single, contested = split_rows(by_number(docs), id_order(doc_id), several)
    judged = (contested.withColumn("rank", id_order(doc_id)).withColumn("text_hash", F.xxhash64(text_or_empty(text)))
              .join(heads, ["rank", "text_hash"], "left_semi").dropDuplicates(["rank", "text_hash"]).drop("rank", "text_hash"))
    return by_name(single.unionByName(judged), docs)
